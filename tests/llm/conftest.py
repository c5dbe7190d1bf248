import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Makes a documents frame from (doc_id, text[, lang[, source]]) rows, with extra columns
    whose names clash with the operators' own."""
    def make(rows, extra=True):
        full = []
        for r in rows:
            doc_id, text, lang, source = (*r, *("en", "src0")[len(r) - 2:])
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        df = spark.createDataFrame(full, DOCS)
        if extra:
            from pyspark.sql import functions as F
            df = df.withColumns({c: F.lit(7) for c in ("fp", "key", "part", "id", "body", "score", "digest", "k", "u", "m")})
        return df
    return make

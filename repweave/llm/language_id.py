"""Language identification (operator 6): Bayesian evidence fusion.

Four kinds of evidence meet in one posterior per document:

* text: a naive Bayes model of hashed byte trigrams of the lower-cased letters, whole texts.
  Trigrams of one text are not independent, so its likelihood counts as at most
  ``EFFECTIVE`` trigrams and the other evidence still matters for short texts;
* the declared markup language: right with probability ``DECLARED_RIGHT``;
* the address suffix and the host: priors from grouped counts of what the text alone says,
  smoothed hierarchically, host towards suffix, suffix towards all documents.

A class for no known language has a uniform likelihood over trigrams. A document is rejected
if that class wins or no language reaches ``min_confidence``.

Declared codes are folded to their primary part, so that en and en-US are one language.
The trigram model is fitted on a bounded sample: about ``sample`` rows for each declared
language, chosen by a hash of the id. Each language that ``MIN_ROWS`` rows declare has a model, if its sample has
letters. Counts for hosts and suffixes cover all rows.

A row that declares a language without a model is not rejected for that: the class for no
known language stands for the declared one, and the verdict is the declared language unless a
model reaches ``min_confidence``.

Defined cases: NULL or empty texts (or those without letters) have no text evidence and are
rejected; NULL declarations and hosts give no evidence of their kind; repeated rows count
each; an empty table, or one that declares no language, rejects all; columns that are not
named as inputs are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repweave.llm.common import bounded_batches, materialise, texts

BUCKETS = 1 << 15
EFFECTIVE = 64
SAMPLE = 1500
#: A language that at least so many rows declare has a model.
MIN_ROWS = 20
DECLARED_RIGHT = 0.9
UNKNOWN_PRIOR = 0.01
HOST_WEIGHT, SUFFIX_WEIGHT = 20.0, 50.0
MIN_CONFIDENCE = 0.5
#: Places that the rows of a host with more than ``HOT_SHARE`` of all rows are dealt to when they meet its prior.
SALTS, HOT_SHARE = 32, 1 / 64
#: Trigrams that are looked up at once, for each language.
GATHERED = 1 << 16

#: Letters (and all beyond ASCII) stay, all else is a blank.
LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def trigrams(text: str) -> np.ndarray:
    """Hashed byte trigrams of a text's letters, words parted by single blanks."""
    words = text.lower().encode().translate(LETTERS).split()
    if not words:
        return np.empty(0, dtype=np.uint32)
    a = np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8).astype(np.uint32)
    code = (a[:-2] << 16) | (a[1:-1] << 8) | a[2:]
    code *= np.uint32(2654435761)
    code >>= np.uint32(17)
    return code


def primary(code: Column) -> Column:
    """The primary part of a language code in lower case (en-US: en); other names as they are."""
    code = F.lower(code)
    return F.coalesce(F.nullif(F.regexp_extract(code, "^([a-z]{2,3})[-_]", 1), F.lit("")), code)


def _declared_languages(rows: DataFrame) -> dict[str, int]:
    counts = rows.where(F.col("declared").isNotNull()).groupBy("declared").agg(F.count(F.lit(1)).alias("n"))
    # a row per language with a model reaches the driver
    return {r["declared"]: r["n"] for r in counts.where(F.col("n") >= MIN_ROWS).collect()}


def fit(rows: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages, and log probabilities (languages x buckets). Counts are summed in Spark;
    the driver gets at most languages x BUCKETS of them."""
    counts = _declared_languages(rows)
    languages = sorted(counts)
    if not languages:
        return [], np.zeros((0, BUCKETS), dtype=np.float32)
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, sample / n)))])
    part = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    chosen = rows.where(F.col("declared").isin(languages)).where(part < share[F.col("declared")])
    place = {k: i for i, k in enumerate(languages)}
    schema = pa.schema([("lang", pa.int32()), ("bucket", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(place), BUCKETS), dtype=np.int64)
        for rb in batches:
            for k, t in zip(rb.column(0).to_pylist(), texts(rb.column(1))):
                total[place[k]] += np.bincount(trigrams(t), minlength=BUCKETS)
        lang, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(bucket, pa.int32()),
                                          pa.array(total[lang, bucket], pa.int64())], schema=schema)

    summed = chosen.select("declared", "body").mapInArrow(run, "lang int, bucket int, n long").groupBy(
        "lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros((len(languages), BUCKETS))
    n[summed["lang"].to_numpy(), summed["bucket"].to_numpy()] = summed["n"].to_numpy()
    some = n.any(axis=1)  # a sample without letters makes no model
    languages, n = [x for x, has in zip(languages, some) if has], n[some] + 0.05
    return languages, np.log(n / n.sum(axis=1, keepdims=True)).astype(np.float32)


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared: Column | None = None,
             host: Column | None = None, suffix: Column | None = None, sample: int = SAMPLE,
             min_confidence: float = MIN_CONFIDENCE, key: Column | None = None) -> DataFrame:
    """(id, declared, lang, confidence, rejected[, key]), a row per row. ``declared``, ``host``
    and ``suffix`` are the evidence columns; ``key`` is carried along."""
    bounded_batches(df.sparkSession)
    none = F.lit(None).cast("string")
    pick = lambda c: none if c is None else F.when(c != "", c.cast("string"))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("body"),
                     primary(pick(declared)).alias("declared"), F.coalesce(F.lower(pick(host)), F.lit("")).alias("host"),
                     F.coalesce(F.lower(pick(suffix)), F.lit("")).alias("suffix"),
                     (F.lit(None) if key is None else key).cast("string").alias("key"))
    languages, logp = fit(rows, sample)
    k = len(languages)
    unknown = -float(np.log(BUCKETS))
    fields = [("id", pa.int64()), ("declared", pa.string()), ("host", pa.string()), ("suffix", pa.string()),
              ("key", pa.string()), ("said", pa.int32()), ("guess", pa.int32()), ("evidence", pa.list_(pa.float64()))]
    schema = pa.schema(fields)
    place = {x: i for i, x in enumerate(languages)} | {None: None}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            guess, evidence = [], []
            said = [place.get(x, -1) for x in rb.column(2).to_pylist()]
            for t in texts(rb.column(1)):
                code = trigrams(t)
                if len(code):
                    total = sum(logp.take(code[i:i + GATHERED], axis=1).sum(axis=1, dtype=np.float64)
                                for i in range(0, len(code), GATHERED))
                    mean = np.append(total / len(code), unknown)
                    evidence.append(min(len(code), EFFECTIVE) * mean)
                    guess.append(int(np.argmax(mean)))
                else:
                    evidence.append(None)
                    guess.append(k)
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), rb.column(2), rb.column(3), rb.column(4), rb.column(5),
                 pa.array(said, pa.int32()), pa.array(guess, pa.int32()), pa.array(evidence, pa.list_(pa.float64()))], schema=schema)

    scored = materialise(rows.select("id", "body", "declared", "host", "suffix", "key").mapInArrow(
        run, "id long, declared string, host string, suffix string, key string, said int, guess int, "
        "evidence array<double>"),
        "language")
    if not k:
        alone = F.col("evidence").isNotNull() & F.col("declared").isNotNull()
        return scored.select("id", "declared", F.when(alone, F.col("declared")).alias("lang"),
                             F.when(alone, 1.0).otherwise(0.0).alias("confidence"), (~alone).alias("rejected"), "key")

    # grouped counts of the text's own verdicts, a row per host and verdict (k: none), rolled up to suffix and all
    tally = materialise(scored.groupBy("suffix", "host", "guess").agg(F.count(F.lit(1)).alias("n")), "hosts")
    every = {r["guess"]: r["n"] for r in tally.groupBy("guess").agg(F.sum("n").alias("n")).collect()}
    n_rows, total = sum(every.values()), sum(n for g, n in every.items() if g < k)
    base = F.array(*[F.lit((every.get(i, 0) + 1) / (total + k)) for i in range(k)])

    def counted(rows: DataFrame, *keys: str) -> DataFrame:
        of = F.col("guess") < k
        return rows.groupBy(*keys).agg(F.coalesce(F.sum(F.when(of, F.col("n"))), F.lit(0)).alias("n"), F.sum("n").alias("all"),
                                       F.map_from_entries(F.collect_list(F.when(of, F.struct("guess", "n")))).alias("of"))

    def smooth(weight: float, towards: Column) -> Column:
        return F.transform(towards, lambda x, i: (F.coalesce(F.try_element_at("of", i), F.lit(0)) + weight * x)
                           / (F.col("n") + weight))

    of_suffix = counted(tally.groupBy("suffix", "guess").agg(F.sum("n").alias("n")), "suffix").select(
        "suffix", smooth(SUFFIX_WEIGHT, base).alias("s"))
    of_host = counted(tally, "suffix", "host").join(of_suffix, "suffix").select(
        "suffix", "host", smooth(HOST_WEIGHT, F.col("s")).alias("prior"))
    names = F.array(*[F.lit(x) for x in languages])
    # declared, but without a model: the last class stands for it
    bare = F.coalesce(F.col("said") == -1, F.lit(False))
    same = lambda i: F.when(F.col("said").isNull(), 0.0).when(F.col("said") == i, np.log(DECLARED_RIGHT)).when(
        bare, np.log((1 - DECLARED_RIGHT) / k)).otherwise(np.log((1 - DECLARED_RIGHT) / max(k - 1, 1)))
    spread = F.when(F.col("said").isNull(), 0.0).when(bare, np.log(DECLARED_RIGHT)).otherwise(np.log(1 / k))
    parts = F.concat(
        F.transform(F.slice("evidence", 1, k), lambda e, i: e + F.log(F.get("prior", i) * (1 - UNKNOWN_PRIOR)) + same(i)),
        F.array(F.get("evidence", F.lit(k)) + F.log(F.lit(UNKNOWN_PRIOR)) + spread))
    # a host may hold a third of all rows: the rows of such a host, of which there are 1 / HOT_SHARE at most, meet
    # copies of its prior in SALTS places
    where = F.concat_ws("/", "host", "suffix")
    hot = where.isin([r["w"] for r in tally.groupBy(where.alias("w")).agg(F.sum("n").alias("n")).where(
        F.col("n") > HOT_SHARE * n_rows).collect()])
    spread_hosts = of_host.withColumn("salt", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(
        F.array(F.lit(0)))))
    salted = scored.withColumn("salt", F.when(hot, F.pmod(F.xxhash64("id", "key", "evidence"), F.lit(SALTS)).cast("int"))
                               .otherwise(0))
    post = (salted.join(spread_hosts, ["suffix", "host", "salt"], "left").withColumn("p", parts)
            .withColumn("top", F.array_max("p"))
            .withColumn("at", F.array_position("p", F.col("top")).cast("int"))
            .withColumn("confidence", F.when(F.col("evidence").isNull(), 0.0).otherwise(
                1 / F.aggregate("p", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("top")))))
            .withColumn("bare", bare & F.col("evidence").isNotNull() & (
                (F.col("at") > k) | (F.col("confidence") < min_confidence)))
            # the share of the last class, as that of the top one is 1 / sum
            .withColumn("confidence", F.when(F.col("bare"), F.col("confidence") * F.exp(
                F.col("p")[k] - F.col("top"))).otherwise(F.col("confidence"))))
    known = F.col("evidence").isNotNull() & (F.col("at") <= k)
    return post.select(
        "id", "declared", F.when(F.col("bare"), F.col("declared")).when(
            known, F.element_at(names, F.least("at", F.lit(k)))).alias("lang"),
        F.round("confidence", 6).alias("confidence"),
        (~F.col("bare") & (~known | (F.col("confidence") < min_confidence))).alias("rejected"), "key")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared_col: str = "lang",
                    host_col: str = "source") -> DataFrame:
    """The documents whose language is identified, with all their columns. Rows are told
    apart by two hashes of what the verdict rests on, so equal rows share it."""
    parts = [x for c in (id_col, text_col, declared_col, host_col) for x in (docs[c], docs[c].isNull())]
    key = F.concat_ws("-", F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts))
    host = F.col(host_col)
    verdict = identify(docs, id_col, text_col, F.col(declared_col), host, suffix_of(host), key=key)
    gone = verdict.where("rejected").select("key").distinct()
    # the columns stand in a struct, so no name can clash
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), key.alias("key"))
    return rows.join(gone, "key", "left_anti").select("doc.*")


def suffix_of(host: Column) -> Column:
    """The last label of a host; empty where it has only one."""
    return F.regexp_extract(host, r"\.([^.:]+)(?::\d+)?$", 1)


def page_columns(pages: DataFrame) -> DataFrame:
    """Pages as (page_id, text, declared, host): tags, scripts and styles cut out."""
    tagless = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"(?s)<!--.*?-->|<[^>]*>", " ")
    return pages.select("page_id", tagless.alias("text"),
                        F.regexp_extract("html", r"(?i)<html[^>]*\blang\s*=\s*[\"']?([A-Za-z]+)", 1).alias("declared"),
                        F.regexp_extract("url", r"://([^/?#:]+)", 1).alias("host"))

"""A training-corpus pipeline over ``documents``, stage by stage.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a frame
that is written as Parquet in the shared folder and read again as the next stage's docs. All
stages but the last return the columns of documents, so each runs on what its predecessor kept:

* language: documents whose language cannot be identified go;
* near_duplicates: one document of each group of near copies stays;
* benchmark: spans of benchmark items go, and documents that are mostly such spans;
* personal_data: personal data is replaced by its kind;
* packing: documents are cut and packed into windows of tokens.

Defined cases: NULL or empty texts are rejected by the first stage; extra columns pass all stages
but the last; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from repweave.llm import decontaminate, language_id, packing, pii, simhash
from repweave.llm.common import materialise, scratch, table
from repweave.llm.queries import tokenizer_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, decontaminate.build(table(spark, sf_dir, "benchmark")), chars_col="n_chars")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs, chars_col="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("benchmark", benchmark),
          ("personal_data", personal_data), ("packing", pack)]

#: Fingerprints and token ids have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. A stage's own table is deleted once its successor is written, as are the tables and
    files that a stage makes on its way; only the last table stays, which the result reads."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with scratch() as made:
            made += before
            docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
            before = [made.pop()]
    return docs

"""Publishing a bundle of tables at once (S10, S15): staged, listed with checksums, then made the latest.

    <base>/bundles/<date>-<id>/<name>/...        the tables, written aside
    <base>/bundles/<date>-<id>/manifest.json     name, rows, checksum and format of each
    <base>/published/<number>.json               which bundle has which date; written last, whole

A reader takes the highest number (the latest), or the highest one of a date. A publication that fails before its
last step, or one that is running, changes nothing that can be read.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repweave.session import path_exists
from repweave.sources import publish as W
from repweave.streaming.ledger import write_text

ENTRY = "number long, date string, bundle string"


def value_checksum(df: DataFrame) -> DataFrame:
    """(rows, checksum) over all columns, whatever the order of rows: doubles to six digits, NULL apart from any text."""
    cells = []
    for c, kind in df.dtypes:
        value = F.col(f"`{c}`")
        text = F.round(value * 1e6).cast("bigint").cast("string") if kind == "double" else value.cast("string")
        cells.append(F.coalesce(text, F.lit("~")))
    row = F.conv(F.substring(F.md5(F.concat_ws("|", *cells)), 1, 8), 16, 10).cast("bigint")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row), F.lit(0)).cast("bigint").alias("checksum"))


def _read(spark: SparkSession, path: str, kind: str, schema: str) -> DataFrame:
    if kind == "csv":
        return spark.read.option("header", True).schema(schema).csv(path)
    return spark.read.schema(schema).parquet(path)


def publish_bundle(tables: dict[str, DataFrame], base: str, date: str, formats: dict[str, str] | None = None) -> list[dict]:
    """Write the tables aside, read them back, list their rows and checksums, and make them the latest bundle and the
    one of ``date``. What is read back must be what was given, else nothing is published."""
    spark = next(iter(tables.values())).sparkSession
    bundle = f"{date}-{uuid.uuid4().hex}"
    listed = []
    for name, df in tables.items():
        kind = (formats or {}).get(name, "parquet")
        path = f"{base}/bundles/{bundle}/{name}"
        (W.write_csv if kind == "csv" else W.write_table)(df, path)
        schema = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
        back = value_checksum(_read(spark, path, kind, schema)).first()
        listed.append({"name": name, "rows": back["rows"], "checksum": back["checksum"], "format": kind, "schema": schema})
    write_text(spark, f"{base}/bundles/{bundle}/manifest.json", json.dumps(listed))
    last = _published(spark, base).agg(F.max("number")).first()[0] or 0
    write_text(spark, f"{base}/published/{last + 1:08d}.json", json.dumps({"number": last + 1, "date": date, "bundle": bundle}))
    return listed


def _published(spark: SparkSession, base: str) -> DataFrame:
    if not path_exists(spark, f"{base}/published"):
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).option("mode", "FAILFAST").json(f"{base}/published")


def listing(spark: SparkSession, base: str, date: str | None = None) -> tuple[str, list[dict]]:
    """Folder and manifest of the latest bundle, or of the last one of a date."""
    entries = _published(spark, base)
    entry = (entries if date is None else entries.where(F.col("date") == date)).orderBy(F.col("number").desc()).first()
    if entry is None:
        raise FileNotFoundError(f"{base}: nothing is published" + (f" for {date}" if date else ""))
    folder = f"{base}/bundles/{entry['bundle']}"
    schema = "name string, rows long, checksum long, format string, schema string"
    found = spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", True).json(f"{folder}/manifest.json")
    return folder, [r.asDict() for r in found.collect()]


def open_table(spark: SparkSession, base: str, name: str, date: str | None = None, verify: bool = False) -> DataFrame:
    """A table of the latest bundle, or of a date's; with ``verify`` its values are held against the manifest."""
    folder, listed = listing(spark, base, date)
    entry = next((e for e in listed if e["name"] == name), None)
    if entry is None:
        raise KeyError(name)
    df = _read(spark, f"{folder}/{name}", entry["format"], entry["schema"])
    if verify:
        now = value_checksum(df).first()
        if (now["rows"], now["checksum"]) != (entry["rows"], entry["checksum"]):
            raise ValueError(f"{name}: {now['rows']} rows with checksum {now['checksum']}, but {entry['rows']} with {entry['checksum']} were published")
    return df

"""A ledger of manifests: what is delivered counts once its manifest stands, and not before.

    <store>/data/delivery=<name>/generation=<id>/...   written aside, never changed
    <store>/ledger/<name>-<number>.json                one manifest per publication of a delivery

A manifest names its delivery, the folder with its data, and the files it came from (path, size, rows,
checksum). Of a delivery's manifests the highest number counts, so a redelivery replaces all the
delivery wrote before, weeks it no longer has included, and a failed one changes nothing.
Manifests appear by a rename, whole; two writers of one number cannot both succeed.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repweave.session import path_exists

FILE = "path string, size long, rows long, checksum string"
MANIFEST = f"delivery string, number long, data string, files array<struct<{FILE}>>"


def folder_name(delivery: str) -> str:
    """A folder for any delivery name; it begins with a letter, so it is never read as a number."""
    return "d" + hashlib.md5(delivery.encode()).hexdigest()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new file, whole or not at all; an error if it exists."""
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = name.getFileSystem(spark._jsc.hadoopConfiguration())
    aside = spark._jvm.org.apache.hadoop.fs.Path(name.getParent(), f"_{uuid.uuid4().hex}")
    out = files.create(aside)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if files.exists(name) or not files.rename(aside, name):
        files.delete(aside, False)
        raise FileExistsError(f"{path} was published by another writer")


def manifests(spark: SparkSession, store: str) -> DataFrame:
    """The manifest that counts of each delivery."""
    if not path_exists(spark, f"{store}/ledger"):
        return spark.createDataFrame([], MANIFEST)
    read = spark.read.schema(MANIFEST).option("mode", "FAILFAST").option("multiLine", True).json(f"{store}/ledger")
    best = read.groupBy("delivery").agg(F.max_by(F.struct(*read.columns), "number").alias("m"))
    return best.select("m.*")


def publish_delivery(spark: SparkSession, store: str, delivery: str, write: Callable[[str], None],
                     files: list[dict] | None = None) -> str:
    """Run ``write`` on a new folder, then publish it as what the delivery holds; returns the folder."""
    last = manifests(spark, store).where(F.col("delivery") == delivery).first()
    number = last["number"] + 1 if last else 1
    data = f"data/delivery={folder_name(delivery)}/generation=g{uuid.uuid4().hex}"
    write(f"{store}/{data}")
    manifest = {"delivery": delivery, "number": number, "data": data, "files": files or []}
    write_text(spark, f"{store}/ledger/{folder_name(delivery)}-{number:08d}.json", json.dumps(manifest))
    return data


def identities(rows: DataFrame, path: str = "_metadata.file_path", size: str = "_metadata.file_size") -> DataFrame:
    """(path, size, rows, checksum) of the files that rows were read from, in one pass over them; the checksum
    does not depend on the order of rows."""
    named = rows.select(F.col(path).alias("_path"), F.col(size).alias("_size"),
                        F.xxhash64(*[F.to_json(F.struct(c)) if t.startswith("map") else F.col(c) for c, t in rows.dtypes]).alias("_h"))
    return named.groupBy(F.col("_path").alias("path"), F.col("_size").cast("long").alias("size")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.concat_ws("-", F.sum(F.col("_h").cast("decimal(38,0)")).cast("string"),
                    F.bit_xor(F.xxhash64("_h")).cast("string")).alias("checksum"))

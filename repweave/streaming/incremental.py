"""Incremental weekly refresh (S17) and refresh of the estimates from the week store.

The store holds week cubes by delivery, published through a ledger of manifests. So

* a week delivered in parts keeps all parts (sums merge by addition when the store is read);
* a repeated or retried delivery replaces all it wrote before, also weeks that it no longer has;
* other deliveries are never read or rewritten.

``deliver`` takes rows under a name of the caller's. ``deliver_files`` names each delivery by its
file: an unchanged file (path, size, checksum) is skipped, a changed one replaces what it gave before.
``refresh_stream`` does the same for the files of each micro-batch, so neither a retried batch nor a
new checkpoint, however it cuts the batches, counts a file twice.

``refresh_estimates`` keeps a feature table by interval. Each interval remembers the publications its two weeks
came from; only intervals whose publications changed are estimated again, and only their partitions are written.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repweave import constants as K
from repweave.operators.cube import geo_week_cube, rollup
from repweave.operators.design import ROLLING, ReplicateDesign
from repweave.plans import feature as FT
from repweave.session import path_exists
from repweave.streaming.ledger import FILE, identities, manifests, publish_delivery, write_text

CUBE_KEYS = ["week", "geo_type", "geography", "race", "rep"]


def deliver(rows: DataFrame, store: str, delivery: str, design: ReplicateDesign = ROLLING,
            metrics: list[str] = K.METRICS, files: list[dict] | None = None) -> None:
    """Cube the rows of one delivery and publish them in place of what the same delivery held before."""
    cube = geo_week_cube(rows, design, metrics)
    publish_delivery(rows.sparkSession, store, delivery,
                     lambda path: cube.write.partitionBy("week").parquet(path), files)


def deliver_files(source: DataFrame, store: str, prepare, design: ReplicateDesign = ROLLING, metrics: list[str] = K.METRICS,
                  path: str = "_metadata.file_path", size: str = "_metadata.file_size") -> list[str]:
    """Deliver the rows of each file that the ledger does not hold as it is; returns their paths. ``prepare``
    turns the rows of a file into estimation input."""
    spark = source.sparkSession
    known = {f["path"]: tuple(f) for m in manifests(spark, store).select("files").collect() for f in m["files"]}
    done = []
    # one row per file of the delivery
    for f in sorted(identities(source, path, size).collect()):
        if known.get(f["path"]) != tuple(f):
            deliver(prepare(source.where(F.col(path) == f["path"])), store, f["path"], design, metrics, [f.asDict()])
            done.append(f["path"])
    return done


def deliveries(spark: SparkSession, store: str) -> DataFrame:
    """(week, delivery, data) of every week that a delivery holds."""
    paths = _folders(spark, store)
    if not paths:
        return spark.createDataFrame([], "week int, delivery string, data string")
    held = _read(spark, store, list(paths)).select("week", "data").distinct()
    names = spark.createDataFrame(list(paths.items()), "data string, delivery string")
    return held.join(names, "data").select("week", "delivery", "data")


def _folders(spark: SparkSession, store: str) -> dict[str, str]:
    return {m["data"]: m["delivery"] for m in manifests(spark, store).select("data", "delivery").collect()}


def _read(spark: SparkSession, store: str, folders: list[str]) -> DataFrame:
    """(cube columns, week, data) of some folders in one scan; a folder without any week has no rows."""
    for folder in folders:
        if not path_exists(spark, f"{store}/{folder}/_SUCCESS"):
            raise FileNotFoundError(f"{store}/{folder}: published, but not there")
    full = [f"{store}/{f}" for f in folders if _has_weeks(spark, f"{store}/{f}")]
    if not full:
        return spark.createDataFrame([], "week int, data string")
    read = spark.read.option("basePath", f"{store}/data").parquet(*full)
    data = F.concat(F.lit("data/delivery="), "delivery", F.lit("/generation="), "generation")
    return read.withColumn("data", data).drop("delivery", "generation")


def _has_weeks(spark: SparkSession, path: str) -> bool:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return any(s.getPath().getName().startswith("week=")
               for s in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root))


def stored_cube(spark: SparkSession, store: str) -> DataFrame:
    """The week cube over all deliveries: their sums, added."""
    folders = _folders(spark, store)
    if not folders:
        raise FileNotFoundError(f"{store}: nothing is delivered")
    return rollup(_read(spark, store, sorted(folders)).drop("data"), CUBE_KEYS)


def refresh_stream(spark: SparkSession, source_dir: str, schema, store: str,
                   checkpoint: str, prepare_batch, design: ReplicateDesign = ROLLING,
                   metrics: list[str] = K.METRICS):
    """Structured Streaming form: the files of each micro-batch are delivered by path."""
    stream = (spark.readStream.schema(schema).parquet(source_dir)
              .select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_size")))

    def on_batch(batch: DataFrame, epoch: int) -> None:
        deliver_files(batch, store, lambda rows: prepare_batch(rows.drop("_file", "_size")), design, metrics, "_file", "_size")

    return (stream.writeStream.foreachBatch(on_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


# ------------------------------------------------------------- estimates ---

def _state(spark: SparkSession, table: str) -> tuple[int, dict]:
    """The latest state of a feature table: its number, and what its intervals came from."""
    if not path_exists(spark, f"{table}/_state"):
        return 0, {}
    read = spark.read.schema("number long, geographies string, intervals map<string,string>").json(f"{table}/_state")
    last = read.orderBy(F.col("number").desc()).first()
    return (last["number"], last.asDict()) if last else (0, {})


def refresh_estimates(spark: SparkSession, store: str, table: str, design: ReplicateDesign = ROLLING,
                      null_geo: str = "keep") -> list[int]:
    """Bring a feature table (partitioned by ``interval_start``) up to the store; returns the intervals that
    were estimated again. A geography that appears or goes changes the grid, so then all intervals are."""
    held = deliveries(spark, store)
    sources: dict[int, list[str]] = {}
    for r in held.select("week", "data").collect():
        sources.setdefault(r["week"], []).append(r["data"])
    n_weeks = max(sources, default=0)
    print_of = {i: hashlib.md5("|".join([*sorted(sources.get(i, [])), "", *sorted(sources.get(i + 1, []))]).encode()).hexdigest()
                for i in range(1, n_weeks)}
    cube = stored_cube(spark, store)
    places = cube.where("rep = 0 and geography is not null").select("geo_type", "geography").distinct()
    geographies = places.agg(F.md5(F.to_json(F.sort_array(F.collect_list(F.struct("geo_type", "geography"))))).alias("h")).first()["h"]
    number, state = _state(spark, table)
    before = state.get("intervals") or {}
    same_grid = state.get("geographies") == geographies
    dirty = [i for i, p in print_of.items() if not same_grid or before.get(str(i)) != p]
    if dirty:
        weeks = sorted({w for i in dirty for w in (i, i + 1)})
        est = FT.estimate_cube(cube.where(F.col("week").isin(weeks)), n_weeks, design, null_geo, places, dirty)
        rows = FT.feature_table(est, sort=False, keep_interval=True)
        (rows.repartition("interval_start").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("interval_start").parquet(table))
    for gone in sorted(int(i) for i in before if int(i) not in print_of):
        FT.remove_folder(spark, f"{table}/interval_start={gone}")
    if dirty or len(before) != len(print_of):
        write_text(spark, f"{table}/_state/{number + 1:08d}.json", json.dumps(
            {"number": number + 1, "geographies": geographies, "intervals": {str(i): p for i, p in print_of.items()}}))
    return dirty

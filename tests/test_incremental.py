"""Refreshing week by week gives the same cube as one pass, and older
weeks are untouched by a refresh."""

import uuid

import pytest

from pyspark.sql import functions as F

from conftest import SF001
from repweave.operators.cube import geo_week_cube, stat_cols
from repweave.operators.design import ROLLING
from repweave.operators.reshape import frame_diff
from repweave.plans import prepare as P
from repweave.session import checkpoint_dir
from repweave.plans import feature as FT
from repweave.streaming.incremental import (deliver, deliver_files, deliveries, refresh_estimates, refresh_stream,
                                             stored_cube)
from repweave.streaming.ledger import manifests

METRICS = ["inc_loss", "food_insufficient"]


KEYS = ["week", "geo_type", "geography", "race", "rep"]


def same(a, b):
    cols = KEYS + stat_cols(METRICS)
    return frame_diff(a.select(*cols), b.select(*cols), KEYS).count() == 0


def test_parts_repeats_and_late_rows_count_once(spark):
    ei = P.estimation_input(P.prepare(spark, SF001)).cache()
    store = f"{checkpoint_dir(spark)}/test-incr-{uuid.uuid4().hex}"
    assert deliveries(spark, store).count() == 0
    deliver(ei.where("week < 6 or (week = 6 and rrace = 1)"), store, "first", ROLLING, METRICS)
    deliver(ei.where("week = 6 and rrace > 1"), store, "late", ROLLING, METRICS)
    deliver(ei.where("week = 6 and rrace > 1"), store, "late", ROLLING, METRICS)     # delivered again
    assert same(stored_cube(spark, store), geo_week_cube(ei.where("week <= 6"), ROLLING, METRICS))
    deliver(ei.where("week > 6"), store, "rest", ROLLING, METRICS)
    assert same(stored_cube(spark, store), geo_week_cube(ei, ROLLING, METRICS))
    assert {(r[0], r[1]) for r in deliveries(spark, store).where("week = 6").collect()} == {(6, "first"), (6, "late")}


def test_a_redelivery_replaces_weeks_it_no_longer_has(spark):
    ei = P.estimation_input(P.prepare(spark, SF001)).where("week <= 4").cache()
    store = f"{checkpoint_dir(spark)}/test-incr-{uuid.uuid4().hex}"
    # names that folders would read as one number
    deliver(ei.where("week <= 3"), store, "01", ROLLING, METRICS)
    deliver(ei.where("week = 4"), store, "1", ROLLING, METRICS)
    deliver(ei.where("week = 1"), store, "01", ROLLING, METRICS)
    assert same(stored_cube(spark, store), geo_week_cube(ei.where("week in (1, 4)"), ROLLING, METRICS))
    assert {(r[0], r[1]) for r in deliveries(spark, store).collect()} == {(1, "01"), (4, "1")}
    deliver(ei.where("week > 9"), store, "01", ROLLING, METRICS)
    assert {(r[0], r[1]) for r in deliveries(spark, store).collect()} == {(4, "1")}


def test_a_failed_delivery_changes_nothing(spark):
    ei = P.estimation_input(P.prepare(spark, SF001)).where("week <= 2").cache()
    store = f"{checkpoint_dir(spark)}/test-incr-{uuid.uuid4().hex}"
    deliver(ei.where("week = 1"), store, "a", ROLLING, METRICS)
    broken = ei.withColumn("repw", F.slice("repw", 1, 3))
    with pytest.raises(Exception):
        deliver(broken, store, "a", ROLLING, METRICS)
    assert same(stored_cube(spark, store), geo_week_cube(ei.where("week = 1"), ROLLING, METRICS))


def test_a_broken_store_is_an_error(spark, tmp_path):
    ei = P.estimation_input(P.prepare(spark, SF001)).where("week = 1")
    with pytest.raises(FileNotFoundError):
        stored_cube(spark, str(tmp_path))
    deliver(ei, str(tmp_path), "a", ROLLING, METRICS)
    data = next((tmp_path / "data").glob("*/*"))
    data.rename(tmp_path / "lost")
    with pytest.raises(FileNotFoundError):
        stored_cube(spark, str(tmp_path)).count()
    (tmp_path / "ledger" / "x.json").write_text("{broken")
    with pytest.raises(Exception):
        stored_cube(spark, str(tmp_path)).count()


def test_a_new_checkpoint_counts_no_file_twice(spark, tmp_path):
    ei = P.estimation_input(P.prepare(spark, SF001)).where("week <= 3").cache()
    source, store = str(tmp_path / "drops"), str(tmp_path / "store")
    ei.where("week = 1").coalesce(1).write.mode("append").parquet(source)
    run = lambda name: refresh_stream(spark, source, ei.schema, store, str(tmp_path / name), lambda df: df, ROLLING,
                                      METRICS).awaitTermination()
    run("one")
    ei.where("week > 1").coalesce(1).write.mode("append").parquet(source)
    # the new checkpoint sees both files in one batch
    run("two")
    assert same(stored_cube(spark, store), geo_week_cube(ei, ROLLING, METRICS))
    assert manifests(spark, store).count() == 2 and manifests(spark, store).agg(F.max("number")).first()[0] == 1


def test_unchanged_files_are_skipped_and_changed_ones_replace(spark, tmp_path):
    ei = P.estimation_input(P.prepare(spark, SF001)).where("week <= 2").cache()
    source, store = tmp_path / "drops", str(tmp_path / "store")
    for w in (1, 2):
        ei.where(f"week = {w}").coalesce(1).write.parquet(f"{source}/w{w}")
        next((source / f"w{w}").glob("part*")).rename(source / f"week_{w}.parquet")
    read = lambda: spark.read.schema(ei.schema).parquet(*[str(source / f"week_{w}.parquet") for w in (1, 2)])
    go = lambda: [p.rpartition("/")[2] for p in deliver_files(read(), store, lambda d: d, ROLLING, METRICS)]
    assert go() == ["week_1.parquet", "week_2.parquet"] and go() == []
    ei.where("week = 2 and rrace > 1").coalesce(1).write.parquet(f"{source}/again")
    next((source / "again").glob("part*")).replace(source / "week_2.parquet")
    spark.catalog.clearCache()
    assert go() == ["week_2.parquet"]
    assert same(stored_cube(spark, store), geo_week_cube(ei.where("week = 1 or rrace > 1"), ROLLING, METRICS))


def test_refresh_estimates_only_dirty_intervals(spark, tmp_path):
    ei = P.estimation_input(P.prepare(spark, SF001)).cache()
    store, table = str(tmp_path / "store"), str(tmp_path / "table")
    deliver(ei.where("week <= 5"), store, "early", ROLLING, METRICS)
    deliver(ei.where("week = 6 and rrace = 1"), store, "sixth", ROLLING, METRICS)
    assert refresh_estimates(spark, store, table) == [1, 2, 3, 4, 5]
    assert refresh_estimates(spark, store, table) == []
    files = lambda i: sorted(p.name for p in (tmp_path / "table" / f"interval_start={i}").glob("part*"))
    before = {i: files(i) for i in range(1, 6)}
    deliver(ei.where("week = 6"), store, "sixth", ROLLING, METRICS)
    deliver(ei.where("week = 7"), store, "seventh", ROLLING, METRICS)
    assert refresh_estimates(spark, store, table) == [5, 6]
    assert all(files(i) == before[i] for i in range(1, 5)) and files(5) != before[5]
    want = FT.feature_table(FT.estimate(ei.where("week <= 7"), ROLLING, METRICS), sort=False)
    got = spark.read.parquet(table)
    assert frame_diff(got.select(*want.columns), want, ["metric", "race_var", "geography", "week_num"]).count() == 0
    # a delivery that takes the last week back
    deliver(ei.where("week > 99"), store, "seventh", ROLLING, METRICS)
    assert refresh_estimates(spark, store, table) == [] and not files(6)


def test_a_new_geography_makes_every_interval_dirty(spark, tmp_path):
    ei = P.estimation_input(P.prepare(spark, SF001)).where("week <= 3").cache()
    store, table = str(tmp_path / "store"), str(tmp_path / "table")
    state = ei.select("state").where("state is not null").orderBy("state").first()[0]
    deliver(ei.where(F.col("state") != state), store, "a", ROLLING, METRICS)
    assert refresh_estimates(spark, store, table) == [1, 2]
    deliver(ei.where((F.col("state") == state) & (F.col("week") == 3)), store, "b", ROLLING, METRICS)
    assert refresh_estimates(spark, store, table) == [1, 2]


def test_stream_keeps_a_week_that_falls_into_two_batches(spark, tmp_path):
    ei = P.estimation_input(P.prepare(spark, SF001)).where("week <= 2").cache()
    source, store = str(tmp_path / "drops"), str(tmp_path / "store")
    for part in ("rrace = 1", "rrace > 1"):
        ei.where(part).coalesce(1).write.mode("append").parquet(source)
        refresh_stream(spark, source, ei.schema, store, str(tmp_path / "progress"), lambda df: df, ROLLING,
                       METRICS).awaitTermination()
    assert same(stored_cube(spark, store), geo_week_cube(ei, ROLLING, METRICS))


def test_interval_cube_equals_recompute_from_rows(spark):
    """Fanning the small week cube out to intervals == fanning respondents out first."""
    from repweave.operators.cube import to_intervals
    from repweave.operators.intervals import rolling_fanout
    ei = P.estimation_input(P.prepare(spark, SF001))
    n = 12
    via_cube = to_intervals(geo_week_cube(ei, ROLLING, METRICS), n)
    rows = rolling_fanout(ei, n).drop("week").withColumnRenamed("interval_start", "week")
    direct = geo_week_cube(rows, ROLLING, METRICS).withColumnRenamed("week", "interval_start")
    keys = ["interval_start", "geo_type", "geography", "race", "rep"]
    cols = keys + stat_cols(METRICS)
    assert frame_diff(via_cube.select(*cols), direct.select(*cols), keys).count() == 0

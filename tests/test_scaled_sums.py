"""Sums by product of weights and values, and plans that stay compiled (frame_diff, publish_bundle, check_manual,
check_published, sigdiff_versions)."""

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from repweave.operators import cube as C
from repweave.operators.by_hand import by_hand
from repweave.operators.design import ROLLING
from repweave.operators.intervals import rolling_fanout
from repweave.plans import prepare as P
from repweave.session import compile_wide_stages
from conftest import SF001

R = ROLLING.n_replicates


def test_the_recodes_are_not_one_method_too_long_to_compile(spark):
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    compile_wide_stages(spark)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_weights_reach_the_sums_without_interpreted_lambdas(spark):
    ei = P.estimation_input(P.prepare(spark, SF001))
    plan = C.geo_week_cube(ei, ROLLING, ["inc_loss"])._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" not in plan and "transform(" not in plan


def test_batches_are_joined_before_they_are_added():
    batches = [pa.record_batch({"a": pa.array(range(n), pa.int64())}) for n in (0, 3, C.BATCH_ROWS, 2)]
    assert [b.num_rows for b in C.joined(iter(batches))] == [C.BATCH_ROWS + 3, 2]
    assert list(C.joined(iter([]))) == []


def test_a_mean_of_ones_is_exactly_one(spark):
    rng = np.random.default_rng(7)
    rows = [(1, ["A", "B", None][i % 3], float(rng.random()), [float(x) for x in rng.random(R)], 1.0, float(rng.random() < 0.5))
            for i in range(300)]
    df = spark.createDataFrame(rows, "week int, race string, pweight double, repw array<double>, x double, y double")
    got = C.sufficient_stats(df, ROLLING, ["x", "y"], ["week", "race"]).collect()
    assert len(got) == 3 * (R + 1) and all(r["swx__x"] == r["sw__x"] for r in got)
    for r in got:
        mine = [(([p, *ws][r["rep"]]) * ROLLING.weight_factor, y) for _, race, p, ws, _, y in rows if race == r["race"]]
        assert r["sw__y"] == pytest.approx(sum(w for w, _ in mine)) and r["swx__y"] == pytest.approx(sum(w * y for w, y in mine))


def test_by_hand_fans_out_sums_as_it_does_rows(spark):
    rows = [(w, s, m, race, x, p, reps) for w, s, m, race, x, p, reps in [
        (1, "A", "m", "white", 1.0, 1.0, [2.0, 1.0]), (2, "A", "m", "black", 0.0, 1.0, [1.0, 3.0]),
        (2, "A", None, "black", 1.0, 1.0, [1.0, None]), (3, "B", None, None, 1.0, None, [1.0, 1.0, 5.0]),
        (3, None, "m", "white", None, 2.0, [1.0, 1.0]), (3, "B", "m", "white", 0.0, 2.0, None), (2, "B", "m", "asian", 1.0, 2.0, [3.0, 1.0])]]
    df = spark.createDataFrame(rows, "week int, state string, cbsa_title string, race string, x double, pweight double, repw array<double>")
    fanned = rolling_fanout(df, 3).withColumn("interval_start", F.col("interval_start").cast("int"))
    keys = ["geo_type", "geography", "interval_start", "race_indicator"]
    a = {tuple(r[k] for k in keys): tuple(r) for r in by_hand(fanned, ["x"]).collect()}
    b = {tuple(r[k] for k in keys): tuple(r) for r in by_hand(df, ["x"], n_weeks=3).collect()}
    assert a.keys() == b.keys() and len(a) == 5 * 2 * 4
    assert all(x == pytest.approx(y) for k in a for x, y in zip(a[k], b[k]))

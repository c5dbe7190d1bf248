"""Hand-computable golden cases G1-G8 (FIXTURES.md section 5): R = 4, scale 1/4, x2."""

import math

import pytest
from pyspark.sql import functions as F

from repweave.operators.design import ReplicateDesign
from repweave.operators.estimate import group_contrast
from repweave.functions.scalar import margins, sigdiff

BASE = [(1, 1.0, 2, 1, 3, 1, 3), (1, 0.0, 2, 3, 1, 1, 3), (0, 1.0, 4, 2, 6, 2, 6),
        (0, 0.0, 4, 6, 6, 2, 2), (0, None, 7, 7, 7, 7, 7)]
D4 = ReplicateDesign(n_replicates=4)


def run(spark, rows, design=D4):
    df = spark.createDataFrame(
        [(g, x, float(w), [float(r) for r in reps]) for g, x, w, *reps in rows],
        "g int, x double, pweight double, repw array<double>")
    out = group_contrast(df, design, "x", "g")
    out = out.withColumns(margins(F.col("mean"), F.col("se"))).withColumn(
        "sigdiff", sigdiff(F.col("diff_mean"), F.col("diff_se")))
    rows = out.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def close(a, b, tol=1e-8):
    if b is None:
        return a is None
    return a is not None and math.isclose(a, b, abs_tol=tol)


def test_g1_base(spark):
    r = run(spark, BASE)
    assert close(r["mean"], 0.5) and close(r["se"], 0.353553391)
    assert close(r["other_mean"], 0.5) and close(r["other_se"], 0.176776695)
    assert close(r["diff_mean"], 0.0) and close(r["diff_se"], 0.353553391)
    assert r["sigdiff"] == 0


def test_g2_empty_group(spark):
    r = run(spark, [row for row in BASE if row[0] == 0])
    assert r["mean"] is None and r["se"] == 0 and r["other_mean"] is None
    assert r["other_se"] == 0 and r["diff_mean"] == 0 and r["diff_se"] == 0
    assert r["moe_95"] == 0 and r["moe_95_lb"] is None and r["moe_95_ub"] is None
    assert r["sigdiff"] is None


def test_g3_exact_zero_and_one(spark):
    r = run(spark, [(1, 1.0, 2, 1, 3, 1, 3), (0, 0.0, 4, 2, 6, 2, 6)])
    assert r["mean"] == 1.0 and r["se"] == 0 and r["other_mean"] == 0.0
    assert r["diff_mean"] == -1.0 and r["diff_se"] == 0 and r["sigdiff"] == 1


def test_g4_zero_over_zero(spark):
    r = run(spark, [(1, 1.0, 2, 1, 3, 1, 3), (0, 1.0, 4, 2, 6, 2, 6)])
    assert r["mean"] == 1.0 and r["other_mean"] == 1.0
    assert r["diff_mean"] == 0 and r["diff_se"] == 0 and r["sigdiff"] is None


def test_g5_replicates_equal_full_weight(spark):
    rows = [(g, x, w, w, w, w, w) for g, x, w, *_ in BASE]
    r = run(spark, rows)
    assert r["se"] == 0 and r["other_se"] == 0 and r["diff_se"] == 0
    assert r["diff_mean"] == 0 and r["sigdiff"] is None


def test_g7_mse_flag(spark):
    rows = [(1, 1.0, 2, 1, 3, 3, 3)] + BASE[1:]
    assert close(run(spark, rows)["se"], 0.433012702)
    assert close(run(spark, rows, ReplicateDesign(n_replicates=4, mse=False))["se"], 0.414578099)


def test_g8_halved_weights(spark):
    r1 = run(spark, BASE)
    r2 = run(spark, BASE, ReplicateDesign(n_replicates=4, weight_factor=0.5))
    for k in ["mean", "se", "other_mean", "other_se", "diff_mean", "diff_se"]:
        assert close(r1[k], r2[k])


def test_antisymmetry(spark):
    a = run(spark, BASE)
    b = run(spark, [(1 - g, *rest) for g, *rest in BASE])
    assert close(a["diff_mean"], -b["diff_mean"]) and close(a["diff_se"], b["diff_se"])
    assert close(a["mean"], b["other_mean"])

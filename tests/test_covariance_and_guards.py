"""Covariance and contrasts against plain numpy and the two-group contrast; failure statuses; join guards; sampling
with replacement; comparison by digests."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from repweave.operators import covariance as C
from repweave.operators.cube import sufficient_stats
from repweave.operators.design import ReplicateDesign
from repweave.operators.estimate import group_contrast
from repweave.operators.joins import JoinGuards
from repweave.operators.reshape import frame_diff, frame_diff_by_digest, sample_with_replacement

R = 6


def rows(n=300, seed=5, groups=4):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        w = rng.uniform(1, 9)
        out.append((int(rng.integers(groups)), int(rng.integers(2)), None if rng.random() < 0.1 else float(rng.integers(2)), w,
                    [float(w * rng.choice([0.5, 1.5])) for _ in range(R)]))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "g int, c int, x double, pweight double, repw array<double>")


def plain(data, mse):
    th = {}
    for c in {r[1] for r in data}:
        for g in {r[0] for r in data}:
            part = [r for r in data if r[0] == g and r[1] == c and r[2] is not None]
            w = np.array([[r[3], *r[4]] for r in part])
            x = np.array([r[2] for r in part])
            th[c, g] = (w * x[:, None]).sum(axis=0) / w.sum(axis=0)
    cov = {}
    for c, i in th:
        for d, j in th:
            if c == d:
                ci, cj = (th[c, i][0], th[c, j][0]) if mse else (th[c, i][1:].mean(), th[c, j][1:].mean())
                cov[c, i, j] = ((th[c, i][1:] - ci) * (th[c, j][1:] - cj)).sum() / R
    return th, cov


@pytest.mark.parametrize("mse", [True, False])
def test_matrix_and_contrast_equal_numpy(spark, mse):
    data, design = rows(), ReplicateDesign(n_replicates=R, mse=mse)
    cube = sufficient_stats(frame(spark, data).repartition(3), design, ["x"], ["c", "g"])
    groups = C.group_replicates(cube, design, ["c"], "g")
    th, cov = plain(data, mse)
    for r in groups.collect():
        assert r["mean"] == pytest.approx(th[r["c"], r["group"]][0]) and r["replicates"] == pytest.approx(th[r["c"], r["group"]][1:].tolist())
    matrix = C.group_matrix(groups, design, ["c"]).cache()
    got = {(r["c"], r["group_i"], r["group_j"]): r["cov"] for r in C.covariances(matrix, ["c"]).collect()}
    assert got.keys() == cov.keys() and all(got[k] == pytest.approx(cov[k], abs=1e-12) for k in cov)
    a = {0: 1.0, 2: -0.25, 3: -0.75}
    for r in C.contrast(matrix, design, ["c"], a).collect():
        c = r["c"]
        assert r["estimate"] == pytest.approx(sum(v * th[c, g][0] for g, v in a.items()))
        assert r["se"] == pytest.approx(2 * sum(v * u * cov[c, g, h] for g, v in a.items() for h, u in a.items()) ** 0.5)
    assert all(r["estimate"] is None and r["se"] is None for r in C.contrast(matrix, design, ["c"], {0: 1, 9: -1}).collect())


def test_one_minus_one_is_the_two_group_contrast(spark):
    data, design = rows(groups=2), ReplicateDesign(n_replicates=R)
    df = frame(spark, data)
    cube = sufficient_stats(df, design, ["x"], ["c", "g"])
    matrix = C.group_matrix(C.group_replicates(cube, design, ["c"], "g"), design, ["c"])
    ours = {r["c"]: r for r in C.contrast(matrix, design, ["c"], {0: 1, 1: -1}).collect()}
    for r in group_contrast(df, design, "x", "g", ["c"]).collect():
        assert ours[r["c"]]["estimate"] == pytest.approx(r["diff_mean"]) and ours[r["c"]]["se"] == pytest.approx(r["diff_se"])


DEFAULT = {"mean": None, "se": 0.0, "other_mean": None, "other_se": 0.0, "diff_mean": 0.0, "diff_se": 0.0, "n1": 0, "n0": 0}


@pytest.mark.parametrize("status,one", [
    ("empty", [(1, 0, None, 1.0)]), ("zero_weight", [(1, 0, 1.0, 0.0), (1, 0, 0.0, 0.0)]),
    ("non_finite", [(1, 0, float("inf"), 1.0)]), ("non_finite", [(1, 0, float("nan"), 1.0)]), ("ok", [(1, 0, 1.0, 1.0)])])
def test_a_cell_that_cannot_be_estimated_is_the_default_row(spark, status, one):
    data = [(*r, [r[3]] * R) for r in one] + [(0, 0, float(i % 2), 2.0, [2.0] * R) for i in range(8)]
    r = group_contrast(frame(spark, data), ReplicateDesign(n_replicates=R), "x", "g").first().asDict()
    assert r["status"] == status
    if status != "ok":
        assert {k: r[k] for k in DEFAULT} == DEFAULT
    else:
        assert r["mean"] == 1.0 and r["other_mean"] == 0.5 and (r["n1"], r["n0"]) == (1, 8)


def test_guards_count_in_the_job_and_fail_on_a_fan_out(spark):
    left = spark.createDataFrame([(i, i % 3) for i in range(9)], "id int, k int")
    for names, ok in (([(0, "a"), (1, "b")], True), ([(0, "a"), (0, "b")], False)):
        guards = JoinGuards()
        right = spark.createDataFrame(names, "k int, name string")
        out = guards.after(guards.before(left, "names").join(right, "k", "left"), "names")
        assert len(out.collect()) == guards.report()[0][2]
        assert guards.report() == [("names", 9, 9 if ok else 12, ok)]
        if ok:
            guards.check()
        else:
            with pytest.raises(ValueError, match="names: 9 rows before, 12 after"):
                guards.check()


def test_sample_with_replacement(spark):
    df = spark.range(500).select(F.col("id"), (F.col("id") % 7).alias("v"))
    a = {(r["id"], r["v"]): r["multiplicity"] for r in sample_with_replacement(df, 900, 3, ["id"], bucket_rows=40).collect()}
    b = {(r["id"], r["v"]): r["multiplicity"] for r in sample_with_replacement(df.repartition(7), 900, 3, ["id"], bucket_rows=10_000).collect()}
    assert a == b and sum(a.values()) == 900 and all(v == i % 7 for i, v in a)
    assert 300 < len(a) < 500 and max(a.values()) < 12
    c = {(r["id"], r["v"]): r["multiplicity"] for r in sample_with_replacement(df, 900, 4, ["id"]).collect()}
    assert c != a
    assert sample_with_replacement(df.limit(0), 5, 1, ["id"]).count() == 0 and sample_with_replacement(df, 0, 1, ["id"]).count() == 0


@pytest.mark.parametrize("buckets", [1, 64, 4096])
def test_digests_find_every_planted_change(spark, buckets):
    a = spark.range(800).select(F.col("id").cast("int").alias("k"), (F.col("id") / 3).alias("x"),
                                F.when(F.col("id") % 5 > 0, F.concat(F.lit("s"), F.col("id"))).alias("s"))
    none = a.where("k = 9").select(F.lit(None).cast("int").alias("k"), "x", "s")
    a = a.unionByName(none)
    b = (a.withColumn("x", F.when(F.col("k") == 17, F.col("x") + 1).when(F.col("k") == 18, F.col("x") + 1e-12).otherwise(F.col("x")))
         .withColumn("s", F.when(F.col("k") == 30, F.lit("other")).otherwise(F.col("s"))).where("k is null or k <> 44")
         .unionByName(spark.createDataFrame([(9000, 1.0, "new")], "k int, x double, s string")))
    key = lambda r: (r["k"] is None, r["k"], r["side"])
    got = sorted(map(key, frame_diff_by_digest(a, b.select("s", "x", "k"), ["k"], buckets=buckets).collect()))
    assert got == sorted(map(key, frame_diff(a, b, ["k"]).collect()))
    assert [(k, s) for _, k, s in got] == [(17, "both"), (30, "both"), (44, "left_only"), (9000, "right_only")]
    assert frame_diff_by_digest(a, a.repartition(5), ["k"], buckets=buckets).count() == 0

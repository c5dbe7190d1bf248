"""Whitening: exact sums against Python integers, axes against a plain eigh."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from repweave.llm import whitening as W


@pytest.mark.parametrize("low,high,n,d", [(-500, 500, 1000, 7), (0, 2, 130, 3), (5, 6, 10, 4), (-2 ** 61, 2 ** 61, 65, 3),
                                          (-2 ** 62, 2 ** 62, 64, 2), (0, 2 ** 30, 1, 5)])
def test_cross_products_are_exact(low, high, n, d):
    x = np.random.default_rng(1).integers(low, high, (n, d))
    sums, products = W.cross_products(x)
    o = x.astype(object)
    assert (products == o.T @ o).all() and (sums == o.sum(axis=0)).all()


def frame(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumns(
        {c: F.lit(1) for c in ("id", "dim", "n", "v", "value", "i", "whitened", "error", "component")})


def vectors(n=3000, d=6, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) * 0.3 + rng.normal(size=d)
    return [(i, v) for i, v in enumerate(x.astype(np.float32).astype(float).tolist())]


def plain(rows):
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    a = np.array([[r[i] - s[i] / n for i in range(d)] for r in x])
    e, u = np.linalg.eigh(a.T @ a / n)
    return x, s, a, e[::-1], u[:, ::-1]


@pytest.mark.parametrize("parts", [1, 5])
def test_equals_plain_whitening(spark, parts):
    rows = vectors()
    bad = [(9001, None), (9002, [float("nan")] * 6), (9003, [0.1, None, 0.0, 0.0, 0.0, 0.0]), (9004, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0]),
           (9005, [float("-inf"), 0.0, 0.0, 0.0, 0.0, 0.0]), (9006, [])]
    got = W.whiten(frame(spark, rows + bad + [rows[0]]).repartition(parts)).collect()
    rows = rows + [rows[0]]
    x, s, a, e, u = plain(rows)
    assert len(got) == 6 * len(rows)
    index = {i: k for k, (i, _) in enumerate(rows)}
    n = len(rows)
    sign = {}
    for r in got:
        k, c = index[r["vec_id"]], r["component"] - 1
        assert r["n"] == n and r["deviation"] == sum((n * xi - si) ** 2 for xi, si in zip(x[k], s)) == int(r["deviation_wide"])
        assert r["explained"] == pytest.approx(e[c] / e.sum(), rel=1e-9)
        want = a[k] @ u[:, c] / math.sqrt(e[c])
        if abs(want) > 1e-3:
            sign.setdefault(c, math.copysign(1, want * r["whitened"]))
            assert r["whitened"] * sign[c] == pytest.approx(want, rel=1e-6)
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_blocks_do_not_change_the_sums(spark):
    df = frame(spark, vectors(500))
    at = lambda b: {(r["i"], r["j"]): r["value"] for r in W.scatter(df, block_rows=b).collect()}
    assert at(7) == at(8192) and at(7)[-1, -1] == 500


def test_defined_cases(spark):
    assert W.whiten(frame(spark, vectors(5)).limit(0)).count() == 0
    # equal rows have no variance
    got = W.whiten(frame(spark, [(1, [0.5, 0.25])] * 3)).collect()
    assert [(r["whitened"], r["explained"], r["identity_error"], r["deviation"]) for r in got] == [(None, None, None, 0)] * 6
    # fewer rows than dimensions: one axis
    got = W.whiten(frame(spark, [(1, [0.5, 0.25, 1.0]), (2, [1.5, 0.0, 1.0])])).collect()
    assert sorted((r["vec_id"], r["component"]) for r in got if r["whitened"] is not None) == [(1, 1), (2, 1)]
    assert max(r["identity_error"] for r in got) < 1e-9
    # lengths are lists of their own; huge entries saturate and deviations beyond 64 bits are wide
    got = W.whiten(frame(spark, [(1, [0.5]), (2, [1.0]), (3, [0.0, 1.0]), (None, [1.0, 0.5]), (5, [1e300, -1e300])], "double")).collect()
    assert {(r["vec_id"], r["n"]) for r in got} == {(1, 2), (2, 2), (3, 3), (None, 3), (5, 3)}
    assert all(r["deviation"] is None for r in got if r["vec_id"] == 5)
    assert {r["vec_id"]: r["deviation"] for r in got}[1] == 512 ** 2

"""Replicate estimates of several groups with their covariance, and any contrast of them.

Per cell (``keys``, metric) the groups' replicate vectors theta_r(g) stand side by side; over replicates

    cov(i, j) = scale * sum_r (theta_r(i) - c_i) (theta_r(j) - c_j)

with c as in ``replicate_var``; replicates that are NULL for either group are skipped, so cov(i, i) is
that function's variance. A contrast sum_i a_i theta(i) has the variance sum_ij a_i a_j cov(i, j).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repweave.operators.cube import metrics_of, n_col, sw_col, swx_col
from repweave.operators.design import ReplicateDesign
from repweave.operators.estimate import _by_metric, _collect_reps


def group_replicates(cube: DataFrame, design: ReplicateDesign, keys: list[str], group: str) -> DataFrame:
    """(keys, metric, group, n, mean, replicates): each group's estimate and its R replicate estimates."""
    long = _by_metric(cube, [*keys, group], metrics_of(cube), {
        "n": lambda m: F.col(n_col(m)), "th": lambda m: F.try_divide(F.col(swx_col(m)), F.col(sw_col(m)))})
    t = _collect_reps(long, [*keys, group], ["n"], ["th"]).where("n > 0")
    return t.select(*keys, "metric", F.col(group).alias("group"), F.col("n").cast("bigint").alias("n"),
                    F.element_at("th", 1).alias("mean"), F.slice("th", 2, design.n_replicates).alias("replicates"))


def _centred(mean: Column, replicates: Column, design: ReplicateDesign) -> Column:
    if design.mse:
        return F.transform(replicates, lambda v: v - mean)
    known = F.filter(replicates, lambda v: v.isNotNull())
    average = F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, v: a + v), F.size(known).cast("double"))
    return F.transform(replicates, lambda v: v - average)


def group_matrix(groups: DataFrame, design: ReplicateDesign, keys: list[str]) -> DataFrame:
    """(keys, metric, groups, means, covariance): one row per cell, groups in order, covariance as rows of the
    k x k matrix. k is the number of groups of a cell."""
    cells = groups.groupBy(*keys, "metric").agg(F.array_sort(F.collect_list(F.struct(
        "group", "mean", _centred(F.col("mean"), F.col("replicates"), design).alias("off")))).alias("g"))
    scale = F.lit(design.var_scale)
    # nested functions see the outer row's groups by their column
    products = F.transform("g", lambda a: F.transform("g", lambda b: scale * F.aggregate(
        F.zip_with(a["off"], b["off"], lambda x, y: F.coalesce(x * y, F.lit(0.0))), F.lit(0.0), lambda s, v: s + v)))
    return cells.select(*keys, "metric", F.transform("g", lambda a: a["group"]).alias("groups"),
                        F.transform("g", lambda a: a["mean"]).alias("means"), products.alias("covariance"))


def covariances(matrix: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, metric, group_i, group_j, cov): the matrices as rows."""
    rows = matrix.select(*keys, "metric", "groups", F.posexplode("covariance").alias("i", "line"))
    cells = rows.select(*keys, "metric", "groups", "i", F.posexplode("line").alias("j", "cov"))
    return cells.select(*keys, "metric", F.get("groups", F.col("i")).alias("group_i"), F.get("groups", F.col("j")).alias("group_j"), "cov")


def contrast(matrix: DataFrame, design: ReplicateDesign, keys: list[str], coefficients: dict) -> DataFrame:
    """(keys, metric, estimate, se): the weighted sum of the groups' means and its error, times the design's
    multiplier. NULL where a cell lacks one of the groups."""
    weight = F.create_map(*[x for g, a in coefficients.items() for x in (F.lit(g), F.lit(float(a)))])
    w = matrix.withColumn("_a", F.transform("groups", lambda g: F.coalesce(F.element_at(weight, g), F.lit(0.0))))
    all_there = F.size(F.array_intersect("groups", F.array(*[F.lit(g) for g in coefficients]))) == len(coefficients)
    add = lambda s, v: s + v
    value = F.aggregate(F.zip_with("_a", "means", lambda a, m: a * m), F.lit(0.0), add)
    lines = F.transform("covariance", lambda line: F.aggregate(F.zip_with("_a", line, lambda a, c: a * c), F.lit(0.0), add))
    variance = F.aggregate(F.zip_with("_a", lines, lambda a, c: a * c), F.lit(0.0), add)
    return w.select(*keys, "metric", F.when(all_there, value).alias("estimate"),
                    F.when(all_there, F.lit(design.se_multiplier) * F.sqrt(F.greatest(variance, F.lit(0.0)))).alias("se"))

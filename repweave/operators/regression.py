"""Weighted least squares with replicate-weight SEs (A15, svyglm-style).

For y = a + b x with weights w, the normal equations only need five sums per
replicate: S = sum w, Sx = sum w x, Sy = sum w y, Sxx = sum w x^2,
Sxy = sum w x y. They merge by addition, so the fit runs as one aggregation
over (cell, replicate) followed by a closed form -- no iterative solver and no
rows gathered anywhere. SE of the slope = m * sqrt(scale * sum_r (b_r - c)^2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repweave.operators.design import ReplicateDesign
from repweave.operators.estimate import replicate_var


def slope(s: Column, sx: Column, sy: Column, sxx: Column, sxy: Column) -> Column:
    """Closed-form WLS slope; NULL when x has no weighted variance."""
    return F.try_divide(s * sxy - sx * sy, s * sxx - sx * sx)


def intercept(s: Column, sx: Column, sy: Column, b: Column) -> Column:
    return F.try_divide(sy - b * sx, s)


def fit_from_sums(sums: DataFrame, design: ReplicateDesign, keys: list[str]) -> DataFrame:
    """(keys, rep, n, s, sx, sy, sxx, sxy) -> (keys, intercept, slope, slope_se, n)."""
    b = slope(F.col("s"), F.col("sx"), F.col("sy"), F.col("sxx"), F.col("sxy"))
    a = intercept(F.col("s"), F.col("sx"), F.col("sy"), b)
    per_rep = sums.select(*keys, "rep", "n", a.alias("a"), b.alias("b"))
    g = per_rep.groupBy(*keys).agg(
        F.max(F.when(F.col("rep") == 0, F.col("n"))).alias("n"),
        F.array_sort(F.collect_list(F.struct("rep", "a", "b"))).alias("_r"))
    bs = F.transform("_r", lambda r: r["b"])
    return g.select(*keys,
                    F.element_at(F.col("_r"), 1)["a"].alias("intercept"),
                    F.element_at(bs, 1).alias("slope"),
                    (F.lit(design.se_multiplier) * F.sqrt(replicate_var(bs, design))).alias("slope_se"),
                    F.col("n").cast("bigint").alias("n"))

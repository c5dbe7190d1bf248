"""Replicate-weight estimators on the cube.

With theta_r(g) = swx_r / sw_r over group g (r = 0 full sample, 1..R replicates):

    var(g)    = scale * sum_{r>=1} (theta_r - c)^2,  c = theta_0 (mse) or mean_r theta_r
    mean      = theta_0(1)          se       = m * sqrt(var(1))
    other     = theta_0(0)          other_se = sqrt(var(0))        (not multiplied)
    diff_mean = theta_0(0) - theta_0(1)
    diff_se   = m * sqrt(scale * sum_r (d_r - c_d)^2),  d_r = theta_r(0) - theta_r(1)

Group 1 / group 0 are "in the cell" / "its complement". Complements are sums
over the *other* classes (never total minus self), so exact 0 and 1 means stay
exact. A cell that cannot be estimated gives the fixed default row (mean NULL, se 0, other NULL,
other_se 0, diff 0, diff_se 0, counts 0), and ``status`` says why: ``empty`` (a side has no
non-NULL values), ``zero_weight`` (a side's weights sum to 0) or ``non_finite`` (a value or an
error is not a finite number); else it is ``ok``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repweave import constants as K
from repweave.operators.cube import (metrics_of, n_col, rollup, stat_cols, sw_col,
                                     swx_col)
from repweave.operators.design import ReplicateDesign

ESTIMATE_COLS = ["mean", "se", "other_mean", "other_se", "diff_mean", "diff_se"]


# ---------------------------------------------------------------- variance ---

def replicate_var(th: Column, design: ReplicateDesign) -> Column:
    """Replicate variance of an ARRAY theta (index 0 = full sample).

    NULL replicates (zero replicate weight in the group) are skipped; the
    scale stays 1/R.
    """
    R = design.n_replicates
    reps = F.slice(th, 2, R)
    if design.mse:
        centre = F.element_at(th, 1)
    else:
        s = F.aggregate(reps, F.lit(0.0), lambda acc, v: acc + F.coalesce(v, F.lit(0.0)))
        k = F.size(F.filter(reps, lambda v: v.isNotNull()))
        centre = F.try_divide(s, k.cast("double"))
    ss = F.aggregate(reps, F.lit(0.0),
                     lambda acc, v: acc + F.coalesce(F.pow(v - centre, 2), F.lit(0.0)))
    return ss * F.lit(design.var_scale)


def _by_metric(df: DataFrame, keys: list[str], metrics: list[str],
               fields: dict[str, callable]) -> DataFrame:
    """Metric columns -> rows: (keys, rep, metric, <fields>)."""
    structs = [F.struct(F.lit(m).alias("metric"),
                        *[fn(m).alias(name) for name, fn in fields.items()])
               for m in metrics]
    return df.select(*keys, "rep", F.inline(F.array(*structs)))


def _collect_reps(df: DataFrame, keys: list[str], counts: list[str],
                  thetas: list[str]) -> DataFrame:
    """(keys, metric, rep, thetas) -> one row per (keys, metric) with ARRAYs
    of the R+1 replicate values ordered by rep (bounded size: R+1)."""
    rep0 = F.col("rep") == 0
    g = df.groupBy(*keys, "metric").agg(
        *[F.max(F.when(rep0, F.col(c))).alias(c) for c in counts],
        F.array_sort(F.collect_list(F.struct("rep", *thetas))).alias("_reps"))
    return g.select(*keys, "metric", *counts,
                    *[F.transform("_reps", _field(t)).alias(t) for t in thetas])


def _field(name: str):
    return lambda s: s[name]


def finish_two_sided(df: DataFrame, design: ReplicateDesign, keys: list[str],
                     metrics: list[str]) -> DataFrame:
    """Side sums per replicate (a_* = group, b_* = complement) -> six estimates."""
    return _finish_sides(_by_metric(df, keys, metrics, {
        "n1": lambda m: F.col("a_" + n_col(m)), "n0": lambda m: F.col("b_" + n_col(m)),
        "th1": lambda m: F.try_divide(F.col("a_" + swx_col(m)), F.col("a_" + sw_col(m))),
        "th0": lambda m: F.try_divide(F.col("b_" + swx_col(m)), F.col("b_" + sw_col(m))),
    }), design, keys)


def _finish_sides(long: DataFrame, design: ReplicateDesign, keys: list[str]) -> DataFrame:
    """(keys, metric, rep, n1, n0, th1, th0) -> six estimates per (keys, metric)."""
    t = _collect_reps(long, keys, ["n1", "n0"], ["th1", "th0"])
    t = t.withColumn("d", F.zip_with("th0", "th1", lambda a, b: a - b))
    m = F.lit(design.se_multiplier)
    finite = lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))
    parts = [F.element_at("th1", 1), F.element_at("th0", 1), *[replicate_var(F.col(c), design) for c in ("th1", "th0", "d")]]
    t = t.withColumns({f"_p{i}": p for i, p in enumerate(parts)})
    no_rows = (F.coalesce("n1", F.lit(0)) == 0) | (F.coalesce("n0", F.lit(0)) == 0)
    t = t.withColumn("status", F.when(no_rows, "empty").when(F.isnull("_p0") | F.isnull("_p1"), "zero_weight")
                     .when(~(finite("_p0") & finite("_p1") & finite("_p2") & finite("_p3") & finite("_p4")), "non_finite")
                     .otherwise("ok"))
    empty = F.col("status") != "ok"
    zero = F.lit(0.0)
    null = F.lit(None).cast("double")
    est = {
        "mean": F.when(empty, null).otherwise(F.col("_p0")),
        "se": F.when(empty, zero).otherwise(m * F.sqrt("_p2")),
        "other_mean": F.when(empty, null).otherwise(F.col("_p1")),
        "other_se": F.when(empty, zero).otherwise(F.sqrt("_p3")),
        "diff_mean": F.when(empty, zero).otherwise(F.element_at("d", 1)),
        "diff_se": F.when(empty, zero).otherwise(m * F.sqrt("_p4")),
    }
    # the default row carries zero counts on both sides
    return t.select(*keys, "metric", *[v.alias(k) for k, v in est.items()],
                    F.when(empty, 0).otherwise(F.col("n1")).cast("bigint").alias("n1"),
                    F.when(empty, 0).otherwise(F.col("n0")).cast("bigint").alias("n0"), "status")


def finish_one_sided(df: DataFrame, design: ReplicateDesign, keys: list[str],
                     metrics: list[str] | None = None) -> DataFrame:
    """A3/A10: per-replicate sums -> mean, se (multiplied), n; cells with no
    non-NULL values are dropped (the metric was filtered to non-NULL first)."""
    metrics = metrics or metrics_of(df)
    long = _by_metric(df, keys, metrics, {
        "n": lambda m: F.col(n_col(m)),
        "th": lambda m: F.try_divide(F.col(swx_col(m)), F.col(sw_col(m))),
    })
    t = _collect_reps(long, keys, ["n"], ["th"]).where(F.col("n") > 0)
    return t.select(*keys, "metric",
                    F.element_at("th", 1).alias("mean"),
                    (F.lit(design.se_multiplier)
                     * F.sqrt(replicate_var(F.col("th"), design))).alias("se"),
                    F.col("n").cast("bigint").alias("n"))


# --------------------------------------------------------------- roll-ups ---

GEO_KEYS = ["interval_start", "week_num"]


def with_complement(df: DataFrame, partition: list[str], order: str,
                    metrics: list[str]) -> DataFrame:
    """a_* = own sums, b_* = sums over all other rows of the partition.

    Prefix + suffix window sums in ``order`` (NULLs first): exact, no
    subtraction from a total, and the partition size is bounded by the number
    of geographies or race groups.
    """
    w = Window.partitionBy(*partition).orderBy(F.col(order).asc_nulls_first())
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    after = w.rowsBetween(1, Window.unboundedFollowing)
    cols = [F.col(c) for c in df.columns if c not in stat_cols(metrics)]
    for c in stat_cols(metrics):
        zero = F.lit(0) if c.startswith("n__") else F.lit(0.0)
        cols.append(F.col(c).alias("a_" + c))
        cols.append((F.coalesce(F.sum(c).over(before), zero)
                     + F.coalesce(F.sum(c).over(after), zero)).alias("b_" + c))
    return df.select(*cols)


def race_vs_rest(gcube: DataFrame, design: ReplicateDesign,
                 groups: list[str] = K.RACE_GROUPS) -> DataFrame:
    """Each race group vs everyone else in the same geography and interval.

    Metrics are stacked at cube grain, then one grouped aggregation sums every group and its
    complement (the other classes, NULL race included) conditionally: no sort, no
    window, and the few race classes of a cell merge map-side.
    """
    cells = gcube.where(F.col("by_race") & F.col("geography").isNotNull())
    at = [*GEO_KEYS, "geo_type", "geography"]
    long = cells.select(*at, "rep", "race", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(n_col(m)).alias("n"), F.col(sw_col(m)).alias("sw"),
                 F.col(swx_col(m)).alias("swx")) for m in metrics_of(gcube)])))

    def side(inside: Column, c: str) -> Column:
        return F.coalesce(F.sum(F.when(inside, F.col(c))), F.lit(0).cast("bigint") if c == "n" else F.lit(0.0))

    pairs = []
    for g in groups:
        own = F.coalesce(F.col("race") == g, F.lit(False))
        pairs.append(F.struct(
            F.lit(g).alias("race_indicator"), side(own, "n").alias("n1"), side(~own, "n").alias("n0"),
            F.try_divide(side(own, "swx"), side(own, "sw")).alias("th1"),
            F.try_divide(side(~own, "swx"), side(~own, "sw")).alias("th0")))
    sides = (long.groupBy(*at, "metric", "rep").agg(F.array(*pairs).alias("pairs"))
             .select(*at, "metric", "rep", F.inline("pairs")))
    return _finish_sides(sides, design, [*at, "race_indicator"])


def geo_vs_rest(gcube: DataFrame, design: ReplicateDesign,
                null_geo: str = "keep") -> DataFrame:
    """Each state / metro vs the rest of the nation (race_indicator 'total').

    ``null_geo='keep'`` counts respondents outside any listed metro in a
    metro's complement; ``'drop'`` limits it to the other metros.
    """
    metrics = metrics_of(gcube)
    g = (gcube.where(~F.col("by_race") & F.col("geo_type").isin("state", "msa"))
         .drop("by_race", "race"))
    if null_geo == "drop":
        g = g.where(F.col("geography").isNotNull())
    sides = with_complement(g, [*GEO_KEYS, "geo_type", "rep"], "geography", metrics)
    sides = (sides.where(F.col("geography").isNotNull())
             .withColumn("race_indicator", F.lit("total")))
    keys = [*GEO_KEYS, "geo_type", "geography", "race_indicator"]
    return finish_two_sided(sides, design, keys, metrics)


def us_total(gcube: DataFrame, design: ReplicateDesign) -> DataFrame:
    """A10: national mean and SE per interval over all non-NULL rows."""
    g = gcube.where(~F.col("by_race") & (F.col("geo_type") == "national"))
    return finish_one_sided(g, design, GEO_KEYS)


def group_contrast(df: DataFrame, design: ReplicateDesign, metric: str,
                   group_col: str, keys: list[str] | None = None) -> DataFrame:
    """A4 + A6 (+ A16): ``group_col == 1`` vs ``group_col == 0`` per cell of ``keys``.

    The general svyby/svycontrast pair on any 0/1 grouping column, from the
    same per-replicate sums: one aggregation to (keys, group, rep), one
    conditional pivot of the two groups, then the shared finish.
    """
    from repweave.operators.cube import sufficient_stats
    keys = keys or []
    cube = sufficient_stats(df.where(F.col(group_col).isin(0, 1)), design, [metric],
                            [*keys, group_col])
    g1 = F.col(group_col) == 1
    aggs = []
    for c in stat_cols([metric]):
        zero = F.lit(0) if c.startswith("n__") else F.lit(0.0)
        aggs.append(F.coalesce(F.sum(F.when(g1, F.col(c))), zero).alias("a_" + c))
        aggs.append(F.coalesce(F.sum(F.when(~g1, F.col(c))), zero).alias("b_" + c))
    sides = cube.groupBy(*keys, "rep").agg(*aggs)
    return finish_two_sided(sides, design, keys, [metric])


def geo_cube_from_weeks(wcube: DataFrame, n_weeks: int) -> DataFrame:
    """Week geo cube -> interval geo cube incl. national and race-collapsed rows,
    in ONE aggregation.

    Cube rows are fanned out to their (<= 2) intervals, state rows are copied
    once more as national rows, and a grouping-sets aggregation emits every
    cell with and without race, with one shuffle.
    """
    from repweave.functions.scalar import interval_label
    from repweave.operators.intervals import interval_column
    metrics = metrics_of(wcube)
    stats = stat_cols(metrics)
    fan = wcube.withColumn("interval_start",
                           F.explode(interval_column(F.col("week"), n_weeks))).drop("week")
    nat = (fan.where(F.col("geo_type") == "state")
           .withColumns({"geo_type": F.lit("national"), "geography": F.lit("US")}))
    allg = fan.unionByName(nat)
    keys = ["interval_start", "geo_type", "geography", "rep"]
    g = allg.groupingSets([[*keys, "race"], keys], *keys, "race").agg(
        F.grouping("race").alias("_gr"), *[F.sum(c).alias(c) for c in stats])
    return g.select("interval_start", interval_label(F.col("interval_start")).alias("week_num"),
                    "geo_type", "geography", "rep", "race",
                    (F.col("_gr") == 0).alias("by_race"), *stats)

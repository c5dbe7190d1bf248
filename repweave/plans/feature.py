"""Estimate job (script-02 equivalent): the full published feature table.

    prepared rows --(1 scan, 1 aggregation)--> week cube
      -> interval cube (each week feeds two intervals)
      -> geo cube (grouping sets: state / metro / nation x with/without race)
      -> race vs rest, geography vs rest, national totals
      -> grid fill (empty cells), margins, flags, date labels, natural order

Only the first aggregation touches respondent rows; every later step works on
the cube, whose size is fixed by the dimension domains.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repweave import constants as K
from repweave.functions.scalar import interval_label, margins, sigdiff
from repweave.operators import estimate as E
from repweave.operators.cube import geo_week_cube
from repweave.operators.design import ROLLING, ReplicateDesign
from repweave.operators.intervals import current_week
from repweave.session import checkpoint_dir, remove_folder

@dataclass
class Estimates:
    geo: DataFrame        # states + metros, all six race indicators
    national: DataFrame   # US, five race groups
    us_total: DataFrame   # US, all respondents
    n_weeks: int
    cube: DataFrame       # the geo cube they all come from


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read
    it back: one job, lineage cut, survives executor loss, and later stages
    plan against a small columnar scan.
    """
    base = checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/repweave-{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def week_cube(df: DataFrame, design: ReplicateDesign = ROLLING,
              metrics: list[str] = K.METRICS) -> tuple[DataFrame, int]:
    """The one respondent-level aggregation, materialised, plus the current
    week (S18) read from the small cube instead of re-scanning respondents."""
    wc = materialize(geo_week_cube(df, design, metrics), "week-cube")
    return wc, current_week(wc)


def geo_cube_of(df: DataFrame, design: ReplicateDesign = ROLLING,
                metrics: list[str] = K.METRICS, n_weeks: int | None = None,
                ) -> tuple[DataFrame, int]:
    """Estimation input rows -> materialised geo cube (and the number of weeks)."""
    wc, n = week_cube(df, design, metrics)
    if n_weeks is not None:
        n = n_weeks
    gc = materialize(E.geo_cube_from_weeks(wc, n), "geo-cube")
    for file in {f.rpartition("/")[0] for f in wc.inputFiles()}:
        remove_folder(df.sparkSession, file)     # nothing reads the week cube any more
    return gc, n


def _grid(geos: DataFrame, starts: list[int], metrics: list[str],
          races: list[str]) -> DataFrame:
    """Metric x race x geography x interval, generated by exploding literal
    arrays on the (small, distinct) geography list -- no cross join."""
    return (geos
            .withColumn("interval_start", F.explode(F.array(*[F.lit(s) for s in starts])))
            .withColumn("metric", F.explode(F.array(*[F.lit(m) for m in metrics])))
            .withColumn("race_indicator", F.explode(F.array(*[F.lit(r) for r in races])))
            .withColumn("week_num", interval_label(F.col("interval_start"))))


def fill_grid(grid: DataFrame, est: DataFrame, keys: list[str]) -> DataFrame:
    """Left-join estimates onto the grid; missing cells get the empty row."""
    j = grid.join(est.drop("week_num"), keys, "left")
    zero = F.lit(0.0)
    return j.withColumns({
        "se": F.coalesce("se", zero), "other_se": F.coalesce("other_se", zero),
        "diff_mean": F.coalesce("diff_mean", zero), "diff_se": F.coalesce("diff_se", zero),
        "n1": F.coalesce("n1", F.lit(0).cast("bigint")),
        "n0": F.coalesce("n0", F.lit(0).cast("bigint")),
        "status": F.coalesce("status", F.lit("empty")),
    })


def estimate_from_geo_cube(gc: DataFrame, n: int, design: ReplicateDesign, metrics: list[str], null_geo: str = "keep",
                           geos: DataFrame | None = None, intervals: list[int] | None = None) -> Estimates:
    """The estimates of a materialised geo cube, for the whole grid or some of its intervals; ``geos``
    (geo_type, geography) are the grid's places, those of the cube if not given."""
    keys = ["interval_start", "metric", "geo_type", "geography", "race_indicator"]
    if geos is None:
        geos = (gc.where(~F.col("by_race") & F.col("geo_type").isin("state", "msa")
                         & F.col("geography").isNotNull() & (F.col("rep") == 0))
                .select("geo_type", "geography").distinct())
    starts = intervals if intervals is not None else list(range(1, n))
    # states, metros and the nation in one pass; both tables below read it
    race = materialize(E.race_vs_rest(gc, design), "race")
    geo_est = race.where(F.col("geo_type") != "national").unionByName(E.geo_vs_rest(gc, design, null_geo))
    geo = fill_grid(_grid(geos, starts, metrics, K.RACE_INDICATORS), geo_est, keys)
    us = gc.sparkSession.createDataFrame([("national", "US")], "geo_type string, geography string")
    nat_est = race.where(F.col("geo_type") == "national")
    national = fill_grid(_grid(us, starts, metrics, K.RACE_GROUPS), nat_est, keys)
    return Estimates(geo=geo, national=national, us_total=E.us_total(gc, design), n_weeks=n, cube=gc)


def estimate(df: DataFrame, design: ReplicateDesign = ROLLING,
             metrics: list[str] = K.METRICS, n_weeks: int | None = None,
             null_geo: str = "keep") -> Estimates:
    """A13 + A14 + A10 on estimation-input rows (see plans.prepare.estimation_input)."""
    gc, n = geo_cube_of(df, design, metrics, n_weeks)
    return estimate_from_geo_cube(gc, n, design, metrics, null_geo)


def estimate_cube(wcube: DataFrame, n_weeks: int, design: ReplicateDesign = ROLLING, null_geo: str = "keep",
                  geos: DataFrame | None = None, intervals: list[int] | None = None) -> Estimates:
    """The same from a stored week cube, as far as ``intervals`` go."""
    from repweave.operators.cube import metrics_of
    gc = E.geo_cube_from_weeks(wcube, n_weeks)
    if intervals is not None:
        gc = gc.where(F.col("interval_start").isin(intervals))
    return estimate_from_geo_cube(materialize(gc, "geo-cube"), n_weeks, design, metrics_of(wcube), null_geo, geos, intervals)


def date_labels(spark: SparkSession) -> DataFrame:
    """Interval -> published date range (fixed 11 rows)."""
    return spark.createDataFrame(K.INTERVAL_DATES, "week_num string, date_int string")


FEATURE_COLS = ["metric", "race_var", "week_num", "geography", "mean", "se", "geo_type",
                "moe_95", "moe_95_lb", "moe_95_ub", "sigdiff", "date_int"]


def feature_table(est: Estimates, sort: bool = True, keep_interval: bool = False) -> DataFrame:
    """The published table."""
    def two_sided(d: DataFrame) -> DataFrame:
        return (d.withColumns(margins(F.col("mean"), F.col("se")))
                .withColumn("sigdiff", sigdiff(F.col("diff_mean"), F.col("diff_se")))
                .withColumnRenamed("race_indicator", "race_var"))

    tot = (est.us_total
           .withColumns(margins(F.col("mean"), F.col("se")))
           .withColumns({"geography": F.lit("US"), "race_var": F.lit("total"),
                         "geo_type": F.lit("national")}))
    rows = (two_sided(est.geo).unionByName(two_sided(est.national), allowMissingColumns=True)
            .unionByName(tot, allowMissingColumns=True))
    spark = est.geo.sparkSession
    out = rows.join(F.broadcast(date_labels(spark)), "week_num", "left")
    cols = [*FEATURE_COLS, "interval_start"]
    out = out.select(*cols)
    if sort:
        out = out.orderBy("metric", "race_var", "geography", "interval_start")
    return out if keep_interval else out.drop("interval_start")

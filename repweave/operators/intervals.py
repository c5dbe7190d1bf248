"""Two-week overlapping intervals.

For n observed weeks there are n-1 intervals ``wk{i}_{i+1}``; week w belongs to
intervals w-1 and w (bounded to 1..n-1), so middle weeks appear twice. The
crosswalk has 2(n-1) rows: it is a literal table, broadcast by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repweave.functions.scalar import interval_label, week_label


def current_week(df: DataFrame, col: str = "week") -> int:
    """The latest week present (a single scalar aggregate)."""
    v = df.agg(F.max(col).alias("m")).first()["m"]
    return int(v) if v is not None else 0


def interval_pairs(n: int) -> list[tuple[int, int]]:
    """(week, interval_start) pairs for n weeks, in crosswalk order."""
    out = []
    for start in range(1, n):
        out.append((start, start))
        out.append((start + 1, start))
    return out


def crosswalk(spark: SparkSession, n: int) -> DataFrame:
    """(week, week_num, interval_start, week_int) for n weeks."""
    df = spark.createDataFrame(interval_pairs(n), "week int, interval_start int")
    return df.select("week", week_label(F.col("week")).alias("week_num"),
                     "interval_start",
                     interval_label(F.col("interval_start")).alias("week_int"))


def interval_column(week, n: int):
    """Array of interval starts containing ``week`` (empty outside 1..n).

    Column form of the crosswalk: ``explode`` of it is the fan-out join J4
    without a join.
    """
    prev_ = F.when((week - 1 >= 1) & (week - 1 <= n - 1), week - 1)
    this_ = F.when((week >= 1) & (week <= n - 1), week)
    return F.filter(F.array(prev_, this_), lambda x: x.isNotNull())


def rolling_fanout(df: DataFrame, n: int, week_col: str = "week") -> DataFrame:
    """J4 + P38: respondent rows -> one row per interval they belong to.

    Adds ``interval_start`` and ``week_num`` (the interval label) and keeps the
    single week as ``week_pt``.
    """
    out = df.withColumn("interval_start",
                        F.explode(interval_column(F.col(week_col), n)))
    if "week_num" in out.columns:
        out = out.withColumnRenamed("week_num", "week_pt")
    return out.withColumn("week_num", interval_label(F.col("interval_start")))

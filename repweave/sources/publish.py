"""Sinks (S10-S16): partitioned microdata writes, feature export, dictionaries, publish bundle."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Name, type and meaning of each published feature column.
FEATURE_DICTIONARY = [
    ("geography", "string", "name of the state or metro area, or US"),
    ("metric", "string", "name of the indicator"),
    ("week_num", "string", "the two survey weeks that are pooled"),
    ("race_var", "string", "race or ethnicity group, or total"),
    ("mean", "float", "weighted share of the group; missing where a side of the comparison has no answers"),
    ("se", "float", "standard error of the mean, twice the replicate error; 0 where the mean is missing, 0 or 1"),
    ("moe_95", "float", "margin of error at 95 percent"),
    ("moe_95_lb", "float", "mean less the margin of error"),
    ("moe_95_ub", "float", "mean plus the margin of error"),
    ("geo_type", "string", "state, msa or national"),
    ("sigdiff", "bool", "whether the group differs from everyone else in the geography (for total: the "
                        "geography from the rest of the nation) at 95 percent"),
]

#: Columns that preparation appends to the microdata, and what they say.
APPENDED_DICTIONARY = [
    ("hisp_rrace", "race and Hispanic origin in one label of five groups"),
    ("uninsured", "1: no insurance, or the Indian Health Service alone; 0: any other insurance"),
    ("insured_public", "1: Medicare, Medicaid or VA insurance; 0: other answers"),
    ("inc_loss", "1: someone in the household lost employment income since mid March; 0: no"),
    ("expect_inc_loss", "1: someone in the household expects to lose employment income in four weeks; 0: no"),
    ("payment_not_conf", "1: little or no confidence in paying rent or mortgage next month, or deferred; 0: confident"),
    ("rent_not_conf", "payment_not_conf of renters"),
    ("mortgage_not_conf", "payment_not_conf of owners with a mortgage"),
    ("rent_not_paid", "1: a renter who did not pay or deferred last month's rent; 0: paid"),
    ("mortgage_not_paid", "1: an owner who did not pay or deferred last month's mortgage; 0: paid"),
    ("food_insufficient", "1: sometimes or often not enough to eat in the last seven days; 0: enough"),
    ("classes_cancelled", "1: a child's classes were cancelled; 0: any other answer about classes"),
    ("stimulus_expenses", "1: a stimulus payment went mostly to expenses; 0: to debt or savings"),
    ("spend_savings", "1: spending met from savings or sold assets; 0: from other sources only"),
    ("spend_credit", "1: spending met by credit cards or loans; 0: from other sources only"),
    ("spend_ui", "1: spending met by unemployment benefits; 0: from other sources only"),
    ("spend_stimulus", "1: spending met by the stimulus payment; 0: from other sources only"),
    ("anxious_score", "0 not at all, 1 several days, 2 over half the days, 3 nearly every day"),
    ("worry_score", "the same score for worrying"),
    ("interest_score", "the same score for little interest"),
    ("down_score", "the same score for feeling down"),
    ("anxiety_signs", "1: anxious and worry scores add up to 3 or more; missing if both are"),
    ("depression_signs", "1: interest and down scores add up to 3 or more; missing if both are"),
    ("depression_anxiety_signs", "1: signs of either; missing if both are"),
    ("week_num", "survey week of the row"),
    ("state", "state of the respondent, short form"),
    ("state_name", "state of the respondent, full name"),
    ("csa_title", "combined statistical area that holds the metro area"),
    ("cbsa_title", "metro area of the respondent"),
]


def feature_dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FEATURE_DICTIONARY, "variable_name string, variable_type string, definition string")


def appended_dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(APPENDED_DICTIONARY, "col_name string, description string")


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_microdata(df: DataFrame, path: str) -> None:
    """Prepared microdata, one partition per week (partition pruning on week)."""
    df.write.mode("overwrite").partitionBy("week").parquet(path)


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int) -> DataFrame:
    """S10 for joins: a table bucketed and sorted on ``keys`` below ``path``, so that tables of one
    bucketing meet without a shuffle. Rows are dealt to buckets first: one file per bucket."""
    # the whole path makes the name, so that no two folders share a table
    name = "bucketed_" + hashlib.md5(path.rstrip("/").encode()).hexdigest()
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
    return df.sparkSession.table(name)


def write_csv(df: DataFrame, path: str) -> None:
    """A small, sorted table as one CSV file."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A written table; filters on a partition column prune its folders."""
    return spark.read.parquet(path)


def publish(tables: dict[str, DataFrame], base_path: str,
            sinks: dict[str, Callable[[DataFrame, str], None]] | None = None) -> DataFrame:
    """Write each table to ``{base_path}/{name}`` (any Hadoop path) by its sink (Parquet by
    default) and return a listing (name, rows) read back from what was written."""
    spark = next(iter(tables.values())).sparkSession
    listing = None
    for name, df in tables.items():
        sink = (sinks or {}).get(name, write_table)
        sink(df, f"{base_path}/{name}")
        back = read_csv(spark, f"{base_path}/{name}") if sink is write_csv else read_parquet(spark, f"{base_path}/{name}")
        row = back.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
        listing = row if listing is None else listing.unionByName(row)
    return listing

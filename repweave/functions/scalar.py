"""Scalar Column helpers shared by estimators, feature table and checks."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repweave import constants as K


def clean_name(name: str) -> str:
    """snake_case a column name (lower case, non-alphanumerics -> '_')."""
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name.strip())
    s = re.sub(r"[^0-9A-Za-z]+", "_", s).strip("_").lower()
    return s or "x"


def clean_names(df: DataFrame) -> DataFrame:
    """Rename every column with ``clean_name``; the second of a clash gets _2, the third _3."""
    seen: dict[str, int] = {}
    out = []
    for n in df.columns:
        base = clean_name(n)
        k = seen.get(base, 0)
        seen[base] = k + 1
        out.append(base if k == 0 else f"{base}_{k + 1}")
    return df.toDF(*out)


def margins(mean: Column, se: Column) -> dict[str, Column]:
    """95 % margin of error and interval bounds."""
    moe = se * F.lit(K.Z_95)
    return {"moe_95": moe, "moe_95_lb": mean - moe, "moe_95_ub": mean + moe}


def sigdiff(diff_mean: Column, diff_se: Column) -> Column:
    """|diff/se| > 1.96 -> 1 else 0, with 0/0 -> NULL and x/0 -> 1.

    Written without dividing by zero (ANSI mode raises on it).
    """
    return (F.when(diff_mean.isNull() | diff_se.isNull(), F.lit(None).cast("int"))
            .when((diff_se == 0) & (diff_mean == 0), F.lit(None).cast("int"))
            .when(diff_se == 0, F.lit(1))
            .when(F.abs(diff_mean / diff_se) > K.Z_95, F.lit(1))
            .otherwise(F.lit(0)))


def geo_type_by_shape(geography: Column) -> Column:
    """P42: 'US' -> national; two characters -> state; otherwise msa."""
    return (F.when(geography == "US", "national")
            .when(F.length(geography) == 2, "state").otherwise("msa"))


def race_short_name(label: Column) -> Column:
    """Published race label -> short race name, other text unchanged."""
    return (F.when(label == K.RACE_LABEL_HISPANIC, "hispanic")
            .when(label == K.RACE_LABEL_WHITE, "white")
            .when(label == K.RACE_LABEL_BLACK, "black")
            .when(label == K.RACE_LABEL_ASIAN, "asian")
            .when(label == K.RACE_LABEL_OTHER, "other")
            .otherwise(label))


def week_label(week: Column) -> Column:
    """P29: 'wk' + week number."""
    return F.concat(F.lit("wk"), week.cast("string"))


def interval_label(start: Column) -> Column:
    """'wk{i}_{i+1}' for the interval that starts at week i."""
    return F.concat(F.lit("wk"), start.cast("string"), F.lit("_"),
                    (start + 1).cast("string"))


def interval_start(label: Column) -> Column:
    """Integer start week of an interval label, for natural ordering (O1)."""
    return F.regexp_extract(label, r"^wk(\d+)_", 1).cast("int")


def str_pad_left(col: Column, width: int, pad: str = "0") -> Column:
    """Left-pad without truncating longer text (``lpad`` truncates)."""
    return F.when(F.length(col) >= width, col).otherwise(F.lpad(col, width, pad))


def extract_or_null(col: Column, pattern: str, group: int = 1) -> Column:
    """E5: regex group, NULL when it does not match (``regexp_extract`` gives '')."""
    return F.nullif(F.regexp_extract(col, pattern, group), F.lit(""))


def within(x: Column, y: Column, tol: float = K.QC_TOLERANCE) -> Column:
    """x in [y - tol, y + tol]."""
    return x.between(y - F.lit(tol), y + F.lit(tol))


def round_doubles(df: DataFrame, digits: int = 9) -> DataFrame:
    """Round every DOUBLE column (used where results are compared by value)."""
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "double":
            cols.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)

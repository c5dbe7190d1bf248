"""Recode edge cases (FIXTURES.md section 5) and interval crosswalks."""

import pytest
from pyspark.sql import functions as F

from repweave.functions import recode
from repweave.operators.intervals import crosswalk, interval_pairs

H = [f"hlthins{i}" for i in range(1, 9)]


def one(spark, values: dict, col: str):
    base = {"rrace": 1, "rhispanic": 1, "tbirth_year": 1980, "tenure": 1, "mortconf": -99,
            "mortlmth": -99, "wrkloss": -99, "expctloss": -99, "curfoodsuf": -99,
            "anxious": -99, "worry": -99, "interest": -99, "down": -99, "eip": -99,
            **{h: -99 for h in H}, **{f"teach{i}": -99 for i in range(1, 6)},
            **{f"spndsrc{i}": -99 for i in range(1, 8)}}
    base.update(values)
    schema = ", ".join(f"{k} int" for k in base)
    df = spark.createDataFrame([tuple(base.values())], schema)
    df = df.withColumns(recode.recode_columns())
    df = df.withColumns({"uninsured_age": recode.age_rule("uninsured"),
                         "insured_public_age": recode.age_rule("insured_public")})
    return df.select(col).first()[0]


@pytest.mark.parametrize("values,col,expected", [
    ({}, "uninsured", None),
    ({}, "insured_public", None),
    ({"hlthins7": 1}, "uninsured", 1.0),
    ({"hlthins7": 1}, "insured_public", 0.0),
    ({"hlthins2": 1, "hlthins7": 1}, "uninsured", 0.0),
    ({h: None for h in H}, "insured_public", 0.0),
    ({"rhispanic": 2, "rrace": 3}, "hisp_rrace", "Hispanic or Latino (may be of any race)"),
    ({"rhispanic": None, "rrace": 2}, "hisp_rrace", "Black alone, not Hispanic"),
    ({"anxious": 4, "worry": None}, "anxiety_signs", 1.0),
    ({"anxious": 3, "worry": -99}, "anxiety_signs", 0.0),
    ({}, "anxiety_signs", None),
    ({"tbirth_year": 1955, "hlthins3": 1}, "insured_public_age", None),
    ({"tbirth_year": 1956, "hlthins3": 1}, "insured_public_age", 1.0),
    ({"eip": 4}, "stimulus_expenses", None),
    ({"mortconf": 5, "tenure": 3}, "rent_not_conf", 1.0),
    ({"mortconf": 5, "tenure": 3}, "mortgage_not_conf", None),
    ({"teach3": 2}, "classes_cancelled", 0.0),
    ({"spndsrc4": 1}, "spend_credit", 0.0),
    ({"interest": 3, "down": 3}, "depression_anxiety_signs", 1.0),
])
def test_recode_edges(spark, values, col, expected):
    assert one(spark, values, col) == expected


def test_intervals_g6(spark):
    got = [(r.week_num, r.week_int) for r in crosswalk(spark, 3).collect()]
    assert got == [("wk1", "wk1_2"), ("wk2", "wk1_2"), ("wk2", "wk2_3"), ("wk3", "wk2_3")]


def test_interval_edges():
    assert interval_pairs(1) == []
    assert interval_pairs(2) == [(1, 1), (2, 1)]
    weeks = [w for w, _ in interval_pairs(12)]
    assert weeks == [1] + [w for w in range(2, 12) for _ in (0, 1)] + [12]

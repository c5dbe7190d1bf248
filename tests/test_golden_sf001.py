"""Golden estimates at sf0.01 from FIXTURES.md section 3 (metric inc_loss)."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from repweave.constants import METRO_AREAS
from repweave.plans import feature as FT
from repweave.plans import prepare as P

COLS = ["mean", "se", "other_mean", "other_se", "diff_mean", "diff_se", "n1", "n0"]


@pytest.fixture(scope="module")
def est(spark):
    ei = P.estimation_input(P.prepare(spark, SF01))
    return FT.estimate(ei, metrics=["inc_loss", "stimulus_expenses"])


@pytest.fixture(scope="module")
def nations(spark):
    return {r.n_nationkey: r.n_name for r in spark.read.parquet(f"{SF01}/nation.parquet").collect()}


def cell(df, metric, race, geo, wk):
    rows = df.where((F.col("metric") == metric) & (F.col("race_indicator") == race)
                    & (F.col("geography") == geo) & (F.col("week_num") == wk)).collect()
    assert len(rows) == 1
    return rows[0]


def check(row, expected):
    for k, v in zip(COLS, expected):
        got = row[k]
        if v is None:
            assert got is None, k
        else:
            assert math.isclose(got, v, abs_tol=2e-9), (k, got, v)


def test_state_race(est, nations):
    check(cell(est.geo, "inc_loss", "asian", nations[0], "wk1_2"),
          [0.493255512, 0.13927451, 0.569348544, 0.049438551, 0.076093032, 0.167813712, 14, 39])


def test_metro_race(est):
    check(cell(est.geo, "inc_loss", "black", METRO_AREAS[3][0], "wk11_12"),
          [0.759911894, 0.224312494, 0.516126543, 0.045876283, -0.243785351, 0.248315753, 5, 31])


def test_state_total(est, nations):
    check(cell(est.geo, "inc_loss", "total", nations[7], "wk5_6"),
          [0.428583981, 0.058042849, 0.501697301, 0.003718993, 0.07311332, 0.058916288, 86, 1583])


def test_metro_total(est):
    check(cell(est.geo, "inc_loss", "total", METRO_AREAS[0][0], "wk1_2"),
          [0.425655589, 0.088084747, 0.502278692, 0.004889847, 0.076623104, 0.090857394, 36, 1625])


def test_national(est):
    check(cell(est.national, "inc_loss", "hispanic", "US", "wk10_11"),
          [0.523406698, 0.021871893, 0.49036823, 0.005488812, -0.033038468, 0.024949915, 334, 1333])
    check(cell(est.national, "stimulus_expenses", "white", "US", "wk6_7"),
          [0.248088112, 0.042499134, 0.248015943, 0.010141074, -0.000072169, 0.044987161, 140, 574])
    check(cell(est.national, "stimulus_expenses", "white", "US", "wk3_4"),
          [None, 0, None, 0, 0, 0, 0, 0])


def test_us_total(est):
    rows = {r.week_num: r for r in est.us_total.where(F.col("metric") == "inc_loss").collect()}
    assert math.isclose(rows["wk1_2"].mean, 0.500359994, abs_tol=2e-9)
    assert math.isclose(rows["wk1_2"].se, 0.009255208, abs_tol=2e-9)
    assert rows["wk1_2"].n == 1661
    assert math.isclose(rows["wk11_12"].mean, 0.502259719, abs_tol=2e-9)
    assert math.isclose(rows["wk11_12"].se, 0.009129307, abs_tol=2e-9)

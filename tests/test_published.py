"""Published tables: normalisers vs oracle are in the driver registry; here the
check must pass on clean cells and fail when one count is changed by 5 %."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from repweave.operators.intervals import crosswalk
from repweave.operators.published import (PASS_SUMS, SPECS, _passes, cell_table, cell_tables, check_against_published, dispatch,
                                          normalise, positional, published_means, published_means_of)
from repweave.plans import feature as FT
from repweave.plans import prepare as P
from repweave.plans import queries as Q


@pytest.fixture(scope="module")
def parts(spark):
    spec = SPECS["food2b"]
    cells = cell_table(Q.survey_rows(spark, SF001), spec).cache()
    ft = FT.feature_table(FT.estimate(P.estimation_input(P.prepare(spark, SF001)),
                                      metrics=["food_insufficient"]), sort=False).cache()
    return spec, cells, ft, crosswalk(spark, 12)


def _check(spec, cells, ft, xw):
    norm = normalise(cells, spec)
    pm = published_means(norm, xw, spec.numerator, spec.denominator, spec.metric)
    return check_against_published(ft, pm)


def test_cell_layout(parts):
    spec, cells, _, _ = parts
    one = cells.where((F.col("sheet") == "US") & (F.col("file") == "food2b_wk1.xlsx"))
    labels = {r.row_idx: r.variable for r in one.collect()}
    assert labels[0] == "Total" and labels[1] == "Hispanic origin and Race"
    assert set(range(2, 7)) <= set(labels)


def test_check_passes_on_clean_cells(parts):
    res = _check(*parts)
    assert res.where(F.col("ok").isNotNull()).count() > 100
    assert res.where(F.col("ok") == False).count() == 0  # noqa: E712


def test_check_fails_on_injected_error(parts):
    spec, cells, ft, xw = parts
    target = (F.col("sheet") == "US") & (F.col("file") == "food2b_wk3.xlsx") \
        & (F.col("variable").contains("White"))
    bad = cells.withColumn("often_not_enough",
                           F.when(target, F.col("often_not_enough") * 1.05)
                           .otherwise(F.col("often_not_enough")))
    res = _check(spec, bad, ft, xw)
    assert res.where(F.col("ok") == False).count() > 0  # noqa: E712


def test_one_sided_cells_are_reported(spark):
    keys = "geography string, week_num string, race_var string, metric string"
    est = spark.createDataFrame([("A", "wk1_2", "asian", "m", 0.5), ("B", "wk1_2", "asian", "m", 0.5),
                                 ("D", "wk1_2", "asian", "m", None)], keys + ", mean double")
    pub = spark.createDataFrame([("A", "wk1_2", "asian", "m", 0.5, 2), ("C", "wk1_2", "asian", "m", 0.5, 2),
                                 ("D", "wk1_2", "asian", "m", 0.4, 2), ("B", "wk2_3", "asian", "m", 0.5, 1)],
                                keys + ", published_mean double, n_weeks long")
    est = est.unionByName(spark.createDataFrame([("B", "wk2_3", "asian", "m", 0.1)], est.schema))
    got = {(r["geography"], r["week_num"]): (r["status"], r["ok"]) for r in check_against_published(est, pub).collect()}
    assert got == {("A", "wk1_2"): ("both", True), ("B", "wk1_2"): ("estimate_only", None), ("C", "wk1_2"): ("published_only", None),
                   ("D", "wk1_2"): ("both", None), ("B", "wk2_3"): ("incomplete_interval", None)}


def test_weeks_outside_every_interval_stay(spark):
    norm = spark.createDataFrame([("v", "A", 1.0, 2.0, "wk1", "asian"), ("v", "A", 3.0, 4.0, "wk99", "asian")],
                                 "variable string, geography string, n double, d double, week_num string, race_var string")
    got = {(r["week_num"], r["published_mean"], r["n_weeks"])
           for r in published_means(norm, crosswalk(spark, 3), "n", "d", "m").collect()}
    assert got == {("wk1_2", 0.5, 1), ("wk99", 0.75, 1)}


def _long(norm, spec):
    keys = ("variable", "geography", "week_num", "race_var")
    return {(spec.name, *[r[k] for k in keys], m): None if r[m] is None else round(r[m], 6)
            for r in norm.collect() for m in spec.keep}


def test_mixed_cells_are_dispatched_by_table(spark):
    # health2b has a file name of its own, housing1b and stimulus1 a first week or two widths
    specs = [SPECS[n] for n in ("health2b", "housing1b", "stimulus1", "educ2")]
    rows = Q.survey_rows(spark, SF001).where("week in (1, 2, 3, 9)").cache()
    mixed = cell_tables(rows, specs, most=20).cache()
    got = {(r["table"], r["variable"], r["geography"], r["week_num"], r["race_var"], r["measure"]):
           None if r["value"] is None else round(r["value"], 6) for r in dispatch(mixed).collect()}
    want = {}
    for s in specs:
        want |= _long(normalise(positional(cell_table(rows, s), s), s), s)
    assert got == want and len({k[0] for k in got}) == 4
    assert {k[3] for k in got if k[0] == "health2b"} == {"wk1", "wk2", "wk3", "wk9"}
    files = {r["file"] for r in mixed.where("table = 'health2b'").select("file").distinct().collect()}
    assert files == {"health2b_wk1.xlsx", "health2b_wk2-full.xlsx", "health2b_wk3.xlsx", "health2b_wk9.xlsx"}


def test_one_aggregation_per_pass():
    parts = _passes(SPECS.values(), PASS_SUMS)
    assert [s for p in parts for s in p] == list(SPECS.values())
    assert all(sum(len(s.counts) + 1 for s in p) <= PASS_SUMS for p in parts) and len(parts) < 4


@pytest.mark.parametrize("table,width", [("nosuch", 6), ("food2b", 5), (None, 6)])
def test_unknown_tables_and_widths_are_errors(spark, table, width):
    cells = spark.createDataFrame([(table, "x_wk1.xlsx", "US", "White alone, not Hispanic", i, [1.0] * width) for i in (1, 2)],
                                  "table string, file string, sheet string, variable string, row_idx int, cells array<double>")
    with pytest.raises(Exception, match="no layout for x_wk1.xlsx"):
        dispatch(cells).collect()


def test_means_of_many_metrics_equal_single_ones(spark, parts):
    spec, cells, _, xw = parts
    one = published_means(normalise(cells, spec), xw, spec.numerator, spec.denominator, spec.metric)
    many = published_means_of(dispatch(positional(cells, spec)), xw, [(spec, spec.metric, spec.numerator, spec.denominator)])
    rows = lambda d: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                            for r in d.select("week_num", "geography", "race_var", "metric", "published_mean", "n_weeks")
                            .fillna(-1.0).collect())
    assert rows(many) == rows(one)

"""Weekly files by header name, sinks, and the order of published tables."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from repweave.plans import feature as FT
from repweave.plans import prepare as P
from repweave.plans import queries as Q
from repweave.sources import publish as W
from repweave.sources.files import coerce_numeric, header_of, read_weekly_csv

COLUMNS = ["scram", "curfoodsuf", "eip", "anxious", "pweight"]


def weekly(tmp_path, files):
    for name, text in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_columns_are_bound_by_name(spark, tmp_path):
    path = weekly(tmp_path, {
        "pulse_06.csv": "SCRAM,Curfoodsuf,anxious,PWeight\nV1,3,2,100.5\n",
        "pulse_07.csv": "scram,curfoodsuf,eip,anxious,pweight\nV1,1,4,1,7\nV2,,x,3,\n",
        "pulse_12.csv": "pweight,anxious,eip,curfoodsuf,scram\n9,1,2,3,V9\n",
        "pulse_13.csv": ""})
    df = coerce_numeric(read_weekly_csv(spark, path, COLUMNS), COLUMNS[1:])
    got = {(r["week"], r["scram"]): (r["curfoodsuf"], r["eip"], r["anxious"], r["pweight"]) for r in df.collect()}
    assert got == {(6, "V1"): (3.0, None, 2.0, 100.5), (7, "V1"): (1.0, 4.0, 1.0, 7.0), (7, "V2"): (None, None, 3.0, None),
                   (12, "V9"): (3.0, 2.0, 1.0, 9.0)}


def test_missing_columns_are_added(spark, tmp_path):
    path = weekly(tmp_path, {"pulse_01.csv": "scram,curfoodsuf\nV1,3\n"})
    df = read_weekly_csv(spark, path, ["scram", "curfoodsuf"])
    assert P.add_drift_columns(df).select("eip", "spndsrc7").first() == (None, None)
    assert read_weekly_csv(spark, path, COLUMNS).first()["eip"] is None


def test_unknown_columns_are_an_error(spark, tmp_path):
    path = weekly(tmp_path, {"pulse_01.csv": "scram,what is this\nV1,3\n"})
    with pytest.raises(ValueError, match="what_is_this"):
        read_weekly_csv(spark, path, COLUMNS)


def test_week_folders_and_quoted_headers(spark, tmp_path):
    path = weekly(tmp_path, {"week=3/part-0.csv": '"Scram","EIP"\n"a,b",1\n'})
    assert header_of(spark, f"{path}/week=3/part-0.csv") == ("Scram", "EIP")
    assert [tuple(r) for r in read_weekly_csv(spark, path, ["scram", "eip"]).collect()] == [(3, "a,b", "1")]


@pytest.fixture(scope="module")
def table(spark):
    ei = P.estimation_input(P.prepare(spark, SF001))
    return FT.feature_table(FT.estimate(ei, metrics=["inc_loss"]))


def test_feature_table_order(table):
    rows = [(r["metric"], r["race_var"], r["geography"], int(r["week_num"][2:].split("_")[0])) for r in table.collect()]
    assert rows == sorted(rows) and (10 in {r[3] for r in rows})


def test_household_size_order(spark):
    rows = [(r["week"], r["mean"]) for r in Q.SPARK["hh_size_by_state_race"](spark, SF001).collect()]
    assert rows == sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0))


def test_feature_csv_keeps_rows_and_order(spark, table, tmp_path):
    W.write_csv(table, str(tmp_path / "csv"))
    back = W.read_csv(spark, str(tmp_path / "csv"))
    assert back.columns == table.columns
    key = ["metric", "race_var", "geography", "week_num"]
    assert [tuple(r[k] for k in key) for r in back.collect()] == [tuple(r[k] for k in key) for r in table.collect()]


def test_microdata_is_pruned_by_week(spark, tmp_path):
    W.write_microdata(spark.range(10).withColumn("week", (F.col("id") % 3).cast("int")), str(tmp_path / "m"))
    back = W.read_parquet(spark, str(tmp_path / "m")).where("week = 1")
    assert back.count() == 3
    assert "PartitionFilters: [isnotnull(week" in back._jdf.queryExecution().toString()


def test_dictionaries_name_every_column(spark):
    assert {r["variable_name"] for r in W.feature_dictionary(spark).collect()} == set(FT.FEATURE_COLS) - {"date_int"}
    named = {r["col_name"] for r in W.appended_dictionary(spark).collect()}
    assert named <= set(P.prepare(spark, SF001).columns)
    assert all(r["definition"] for r in W.feature_dictionary(spark).collect())


def test_by_hand_formula_on_a_small_design(spark):
    """Four replicates worked out by hand: the factor is 4 / 80 whatever the design."""
    from repweave.operators.by_hand import by_hand
    rows = [(1, "A", None, "white", 1.0, 1.0, [2.0, 1.0]), (1, "A", None, "black", 0.0, 1.0, [1.0, 3.0]),
            (1, "A", None, "black", 1.0, 1.0, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "interval_start int, state string, cbsa_title string, race string, m double, pweight double, "
                                     "repw array<double>")
    got = {(r["geo_type"], r["race_indicator"]): r for r in by_hand(df, ["m"]).collect()}
    # white 1, others 1/2; replicates of the others: 1/2 and 1/4
    assert got["state", "white"]["hand_diff_mean"] == pytest.approx(-0.5)
    assert got["state", "white"]["hand_diff_se"] == pytest.approx((4 / 80 * 0.25 ** 2) ** 0.5)
    # total 2/3; replicates 3/4 and 2/5
    assert got["national", "white"]["hand_total_mean"] == pytest.approx(-1 / 3)
    assert got["national", "white"]["hand_total_se"] == pytest.approx((4 / 80 * ((1 / 12) ** 2 + (4 / 15) ** 2)) ** 0.5)
    assert got["state", "asian"]["hand_diff_mean"] is None


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    a = W.write_bucketed(spark.range(200).selectExpr("id % 5 as week", "id as scram", "1 as x"), str(tmp_path / "left_side"), ["week", "scram"], 4)
    b = W.write_bucketed(spark.range(100).selectExpr("id % 5 as week", "id as scram", "2 as y"), str(tmp_path / "right_side"), ["week", "scram"], 4)
    j = a.join(b.hint("merge"), ["week", "scram"], "left")
    assert j.count() == 200 and j.where("y = 2").count() == 100
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan

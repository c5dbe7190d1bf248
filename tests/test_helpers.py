"""Scalar helpers, join guards, reshape operators."""

import pytest
from pyspark.sql import functions as F

from repweave.functions.scalar import (clean_name, extract_or_null, geo_type_by_shape,
                                       interval_start, race_short_name, sigdiff, str_pad_left,
                                       within)
from repweave.operators.joins import bounded_broadcast, fanout_violations, left_lookup
from repweave.operators.reshape import frame_diff, group_mean, one_hot, pad_missing, sample_rows


def test_clean_name():
    assert clean_name("CBSA Title") == "cbsa_title"
    assert clean_name("week.x") == "week_x"
    assert clean_name("Los Angeles-Long Beach") == "los_angeles_long_beach"


def test_scalar_columns(spark):
    df = spark.createDataFrame(
        [("US", 0.0, 0.0, "7", "food2b_wk7.xlsx", "wk10_11"),
         ("CA", 1.0, 0.0, "123", "nothing", "wk2_3"),
         ("Atlanta-Sandy Springs-Roswell, GA", 3.0, 1.0, None, "x_wk12.xlsx", "wk1_2")],
        "g string, d double, s double, p string, f string, w string")
    rows = df.select(geo_type_by_shape(F.col("g")).alias("t"),
                     sigdiff(F.col("d"), F.col("s")).alias("sig"),
                     str_pad_left(F.col("p"), 2).alias("pad"),
                     extract_or_null(F.col("f"), r"_(.*?)\.xlsx").alias("wk"),
                     interval_start(F.col("w")).alias("i")).collect()
    assert [r.t for r in rows] == ["national", "state", "msa"]
    assert [r.sig for r in rows] == [None, 1, 1]
    assert [r.pad for r in rows] == ["07", "123", None]
    assert [r.wk for r in rows] == ["wk7", None, "wk12"]
    assert [r.i for r in rows] == [10, 2, 1]


def test_within_and_race_names(spark):
    df = spark.createDataFrame([(0.5, 0.502), (0.5, 0.5021)], "x double, y double")
    assert [r[0] for r in df.select(within(F.col("x"), F.col("y"))).collect()] == [True, False]
    lab = spark.createDataFrame([("Asian alone, not Hispanic",), ("Total",)], "v string")
    assert [r[0] for r in lab.select(race_short_name(F.col("v"))).collect()] == ["asian", "Total"]


def test_left_lookup_never_fans_out(spark):
    facts = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1, "a"), (1, "dup"), (2, "b")], "code int, name string")
    out = left_lookup(facts, dim, "k", "code")
    assert out.count() == 3
    assert fanout_violations(facts, out, ["k"]).count() == 0
    bad = facts.join(dim, facts.k == dim.code, "left")
    assert fanout_violations(facts, bad, ["k"]).count() == 1


def test_bounded_broadcast_respects_bound(spark):
    small = spark.range(10)
    big = spark.range(1000)
    hinted = small.join(bounded_broadcast(small, 100), "id")._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in hinted.lower()
    # a side above the bound is left to the planner
    plan = big.join(bounded_broadcast(big, 100), "id")._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in plan.lower()


def test_one_hot_null_column(spark):
    df = spark.createDataFrame([("CA",), ("New York",), (None,)], "state string")
    out = one_hot(df, "state")
    assert set(out.columns) == {"state", "state_ca", "state_new_york", "state_na"}
    rows = {r.state: r for r in out.collect()}
    assert rows[None].state_na == 1 and rows[None].state_ca == 0


def test_group_mean_strict_nulls(spark):
    df = spark.createDataFrame([(1, 2.0), (1, None), (2, 4.0)], "g int, x double")
    got = {r.g: r.mean for r in group_mean(df, ["g"], "x").collect()}
    assert got == {1: None, 2: 4.0}
    got = {r.g: r.mean for r in group_mean(df, ["g"], "x", na_rm=True).collect()}
    assert got == {1: 2.0, 2: 4.0}


def test_pad_missing_and_sample(spark):
    grid = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    present = spark.createDataFrame([(1, 0.5)], "k int, v double")
    out = {r.k: r.v for r in pad_missing(grid, present, ["k"]).collect()}
    assert out == {1: 0.5, 2: None, 3: None}
    s1 = [r.id for r in sample_rows(spark.range(100), 5, 7, ["id"]).collect()]
    s2 = [r.id for r in sample_rows(spark.range(100), 5, 7, ["id"]).collect()]
    assert s1 == s2 and len(set(s1)) == 5


def test_frame_diff_tolerance(spark):
    a = spark.createDataFrame([(1, 0.1), (2, 0.2)], "k int, v double")
    b = spark.createDataFrame([(1, 0.1 + 1e-12), (3, 0.3)], "k int, v double")
    got = {(r.k, r.side) for r in frame_diff(a, b, ["k"]).collect()}
    assert got == {(2, "left_only"), (3, "right_only")}


def test_layout_is_chosen_by_width(spark):
    from repweave.operators.published import choose_layout
    cells = spark.createDataFrame([("a", [1.0, 2.0, None]), ("b", [4.0, None])], "file string, cells array<double>")
    layouts = {3: ["total", "owner", "no_response"], 2: ["total", "no_response"]}
    got = {r["file"]: (r["total"], r["owner"], r["no_response"]) for r in choose_layout(cells, layouts).collect()}
    assert got == {"a": (1.0, 2.0, None), "b": (4.0, None, None)}
    with pytest.raises(Exception, match="no layout for a"):
        choose_layout(cells, {2: layouts[2]}).collect()



def test_coerce_numeric(spark):
    from repweave.sources.files import coerce_numeric
    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "v string")
    assert [r.v for r in coerce_numeric(df, ["v"]).collect()] == [1.5, None, None]


def test_one_hot_names_never_clash(spark):
    df = spark.createDataFrame([("St. Louis",), ("St Louis",), ("na",), (None,), ("x",)], "g string")
    rows = one_hot(df, "g").collect()
    hot = {r["g"]: [c for c in rows[0].__fields__ if c != "g" and r[c] == 1] for r in rows}
    assert hot == {"St. Louis": ["g_st_louis_2"], "St Louis": ["g_st_louis"], "na": ["g_na_2"], None: ["g_na"], "x": ["g_x"]}
    assert one_hot(df, "g", levels=["x", None]).columns == ["g", "g_x", "g_na"]


def test_one_hot_has_no_level_cap(spark):
    df = spark.range(1200).selectExpr("concat('v', id) as g")
    assert len(one_hot(df, "g").columns) == 1201


def test_lookup_duplicates_are_deterministic_and_reported(spark):
    from repweave.operators.joins import duplicate_keys, left_lookup
    dim = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (2, "c")], "code int, name string")
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    for parts in (1, 3):
        got = {r["k"]: r["name"] for r in left_lookup(df, dim.repartition(parts), "k", "code").collect()}
        assert got == {1: "a", 2: "c", 3: None}
    assert [(r["code"], r["n_rows"]) for r in duplicate_keys(dim, "code").collect()] == [(1, 2)]


def test_clean_names_number_clashes(spark):
    from repweave.functions.scalar import clean_names
    assert clean_names(spark.createDataFrame([(1, 2, 3)], ["A b", "a.b", "a_b"])).columns == ["a_b", "a_b_2", "a_b_3"]


def test_checkpoint_folder_needs_a_shared_setting(spark):
    from types import SimpleNamespace

    from repweave.session import checkpoint_dir
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: None),
                           sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"))
    with pytest.raises(RuntimeError):
        checkpoint_dir(fake)

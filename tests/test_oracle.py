"""Registered queries vs their DuckDB oracle, compared like the driver does
(sorted column names, row count, order-insensitive value hash)."""

import pytest

from conftest import SF001

FAST = ["recode_race", "recode_mental_health", "recode_age_filter", "race_indicators",
        "enrich_state", "enrich_metro", "enrich_weights", "join_guard", "week_intervals",
        "rolling_fanout", "schema_drift_union", "current_week", "svy_mean", "us_total",
        "contrast_race_us"]


@pytest.fixture(scope="module")
def duckcon():
    from compare import duck
    return duck(SF001)


def test_registry_consistent():
    import __spark_entry__ as E
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 30


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duckcon, name):
    import __spark_entry__ as E
    from compare import compare
    r = compare(E.queries()[name](spark, SF001), duckcon, E.oracle_sql()[name])
    assert r["cols_match"], r
    assert r["rows_spark"] == r["rows_duck"], r
    assert r["hash_match"], r

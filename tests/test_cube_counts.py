"""The cube counts the rows of every replicate (S17, incremental_weeks)."""

from pyspark.sql import functions as F

from repweave.operators.cube import geo_week_cube, sufficient_stats
from repweave.operators.design import ROLLING

R = ROLLING.n_replicates


def rows(spark):
    df = spark.createDataFrame(
        [(1, "A", "m", "white", 10.0, 1.0), (1, "A", None, "white", 20.0, None), (1, "A", "m", "white", 30.0, 0.0),
         (2, "B", "m", None, None, 1.0)],
        "week int, state string, cbsa_title string, race string, pweight double, x double")
    return df.withColumn("repw", F.array(*[F.coalesce("pweight", F.lit(1.0)) * (1 + r % 2) for r in range(R)]))


def test_every_replicate_counts_its_rows(spark):
    got = {(r["week"], r["race"], r["rep"]): r["n__x"] for r in sufficient_stats(rows(spark), ROLLING, ["x"], ["week", "race"]).collect()}
    assert got == {(w, race, rep): n for w, race, n in ((1, "white", 2), (2, None, 1)) for rep in range(R + 1)}


def test_geo_cube_counts_by_replicate(spark):
    cube = geo_week_cube(rows(spark), ROLLING, ["x"])
    got = {tuple(r) for r in cube.groupBy("geo_type", "rep").agg(F.sum("n__x")).collect()}
    assert got == {(t, rep, 3) for t in ("state", "msa") for rep in range(R + 1)}

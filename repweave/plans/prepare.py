"""Prepare job (script-01 equivalent): recode, enrich, attach replicate weights.

Plan shape: parquet scan -> one codegen'd Project of all recodes -> two
broadcast lookups (states, metros; both bounded dimension tables) -> one
shuffle join with the replicate-weight table on (week, scram). The week is
part of the key because respondent ids are only unique within a week.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repweave.constants import DRIFT_COLUMNS, METRO_AREAS, N_REPLICATES
from repweave.functions import recode
from repweave.functions.scalar import week_label
from repweave.operators.joins import JoinGuards, left_lookup
from repweave.sources import testdata


def add_drift_columns(df: DataFrame) -> DataFrame:
    """Columns absent from early weekly files are added as NULL."""
    missing = {c: F.lit(None).cast("double") for c in DRIFT_COLUMNS if c not in df.columns}
    return df.withColumns(missing) if missing else df


def recode_microdata(raw: DataFrame) -> DataFrame:
    """P3-P29 as one projection."""
    df = add_drift_columns(raw).withColumns(recode.recode_columns())
    return df.withColumns({
        "est_msa": F.col("est_msa").cast("int").cast("string"),   # P28: via int, not '47.0'
        "week_num": week_label(F.col("week")),                     # P29
    })


def repweights_array(repw: DataFrame, n: int = N_REPLICATES) -> DataFrame:
    """Wide pweight1..pweightN -> one ARRAY<DOUBLE> column ``repw``."""
    return repw.select("week", "scram",
                       F.array(*[F.col(f"pweight{r}") for r in range(1, n + 1)]).alias("repw"))


def enrich(df: DataFrame, states: DataFrame, metros: DataFrame,
           repw: DataFrame, metro_rows: int | None = None, guards: JoinGuards | None = None) -> DataFrame:
    """State names, metro names, replicate weights (all left joins). ``metro_rows``
    is the size of a literal metro table, which then needs no counting job. With ``guards`` the job
    counts the rows of each join as it runs."""
    before = guards.before if guards else lambda d, name: d
    after = guards.after if guards else lambda d, name: d
    out = after(left_lookup(before(df, "states"), states, "est_st", "state_code", max_rows=10_000), "states")
    out = after(left_lookup(before(out, "metros"), metros, "est_msa", "cbsa_code", max_rows=10_000, known_rows=metro_rows), "metros")
    # Both sides grow with the data -> shuffle (sort-merge) join on
    # (week, scram); never a broadcast, whatever a small test file suggests.
    return after(before(out, "weights").join(repweights_array(repw).hint("merge"), ["week", "scram"], "left"), "weights")


def prepare(spark: SparkSession, sf_dir: str, guards: JoinGuards | None = None) -> DataFrame:
    """Prepared microdata: inputs + indicators + geography names + ``repw``."""
    raw = testdata.raw_microdata(spark, sf_dir)
    return enrich(recode_microdata(raw),
                  testdata.state_table(spark, sf_dir),
                  testdata.metro_table(spark),
                  testdata.raw_repweights(spark, sf_dir), metro_rows=len(METRO_AREAS), guards=guards)


def estimation_input(prepared: DataFrame) -> DataFrame:
    """Script-02 derive step: age rule (P30) on insurance metrics + race group."""
    return prepared.withColumns({
        "insured_public": recode.age_rule("insured_public"),
        "uninsured": recode.age_rule("uninsured"),
        "race": recode.race_group(),
    })

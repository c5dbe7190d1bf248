"""Survey-shaped views over the driver's TPC-H-style parquet tables.

The test data carries no survey table, so the weekly microdata is a
deterministic projection of ``orders`` x ``customer`` (one respondent per
order, see FIXTURES.md section 3). Everything is plain Column arithmetic on
bigint keys, so Catalyst keeps it in one codegen'd projection over a pruned
parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repweave import constants as K
from repweave.constants import METRO_AREAS, N_REPLICATES

PRIME = 1000003

#: Answer codes of educ3 (device, intrnt: 1 always .. 5 never), health1 (delay, notget: 1 yes, 2 no)
#: and employ2 (anywork: 1 yes, 2 no; kindwork: 1 government .. 5 family business).
MORE_CODES = [("device", 433494437, 9, 5), ("intrnt", 472882027, 9, 5), ("delay", 492876847, 7, 2),
              ("notget", 512927357, 7, 2), ("anywork", 533000389, 7, 2), ("kindwork", 553105253, 9, 5)]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _h(key: Column, mult: int, mod: int) -> Column:
    """((key+1)*mult) % PRIME % mod on bigint."""
    return ((key + F.lit(1)) * F.lit(mult)) % F.lit(PRIME) % F.lit(mod)


def _coded(key: Column, mult: int, mod: int, inner_mod: int) -> Column:
    """-88 / -99 sentinels on residues 0 / 1, otherwise residue % inner_mod + 1."""
    r = _h(key, mult, mod)
    return (F.when(r == 0, F.lit(-88)).when(r == 1, F.lit(-99))
            .otherwise(r % inner_mod + 1))


def _week(k: Column) -> Column:
    return (_h(k, 7919, 12) + 1).cast("int")


def _hlthins(k: Column, mult: int) -> Column:
    gate = _h(k, 236887691, 10)
    inner = _h(k, mult, 5)
    return (F.when(gate == 0, -88).when(gate == 1, -99)
            .otherwise(F.when(inner == 0, 1).when(inner == 1, -99).otherwise(2)))


def _teach(k: Column, mult: int) -> Column:
    return (F.when(_h(k, 373587883, 3) == 0, -88)
            .otherwise(F.when(_h(k, mult, 4) == 0, 1).otherwise(-99)))


def _spndsrc(k: Column, mult: int) -> Column:
    gate = _h(k, 413158511, 8)
    inner = F.when(gate == 0, -88).when(gate == 1, -99).otherwise(
        F.when(_h(k, mult, 3) == 0, 1).otherwise(-99))
    return F.when(_week(k) >= 7, inner)


def microdata_columns(k: Column, nationkey: Column) -> list[Column]:
    """Projection columns of one respondent row keyed by ``o_orderkey``."""
    cols = [
        k.alias("o_orderkey"),
        F.concat(F.lit("V"), k.cast("string")).alias("scram"),
        _week(k).alias("week"),
        nationkey.alias("est_st"),
        F.when(_h(k, 32452843, 3) == 0,
               _h(k, 49979687, 15).cast("int")).alias("est_msa"),
        (_h(k, 104729, 4) + 1).alias("rrace"),
        F.when(_h(k, 15485863, 5) == 0, F.lit(2)).otherwise(F.lit(1)).alias("rhispanic"),
        (_h(k, 67867967, 73) + 1930).alias("tbirth_year"),
        (_h(k, 86028121, 4) + 1).alias("tenure"),
        (_h(k, 256203161, 9) + 1).alias("thhld_numper"),
        _coded(k, 122949823, 8, 5).alias("mortconf"),
        _coded(k, 198491317, 7, 3).alias("mortlmth"),
        _coded(k, 141650939, 6, 2).alias("wrkloss"),
        _coded(k, 179424673, 6, 2).alias("expctloss"),
        _coded(k, 275604541, 9, 4).alias("curfoodsuf"),
        _coded(k, 295075147, 9, 4).alias("anxious"),
        _coded(k, 314606869, 9, 4).alias("worry"),
        _coded(k, 334214459, 9, 4).alias("interest"),
        _coded(k, 353868013, 9, 4).alias("down"),
    ]
    for i, mult in enumerate([15493787, 15501707, 15509627, 15517547,
                              15525467, 15533387, 15541307, 15549227], start=1):
        cols.append(_hlthins(k, mult).alias(f"hlthins{i}"))
    for i, mult in enumerate([32460787, 32468707, 32476627, 32484547, 32492467], start=1):
        cols.append(_teach(k, mult).alias(f"teach{i}"))
    cols.append(F.when(_week(k) >= 7, _coded(k, 393342739, 7, 4)).alias("eip"))
    for i, mult in enumerate([49987613, 49995533, 50003453, 50011373,
                              50019293, 50027213, 50035133], start=1):
        cols.append(_spndsrc(k, mult).alias(f"spndsrc{i}"))
    for name, mult, mod, inner in MORE_CODES:
        cols.append(_coded(k, mult, mod, inner).alias(name))
    cols.append(_pweight(k).alias("pweight"))
    return cols


def _pweight(k: Column) -> Column:
    return (_h(k, 160481183, 900) + 100).cast("double")


def raw_microdata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All weeks of respondent microdata, stacked (one row per order)."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # customer is a dimension (15k rows per 0.1 SF): let AQE pick broadcast from
    # runtime size; no hint, because customer grows with the scale factor.
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
    return joined.select(*microdata_columns(F.col("o_orderkey"), F.col("c_nationkey")))


def replicate_factor(k: Column, r: int) -> Column:
    """Replicate r multiplies the full weight by 0.5 or 1.5."""
    return F.lit(0.5) + ((k + F.lit(1)) * F.lit((2 * r + 1) * 7919)) % F.lit(PRIME) % F.lit(2)


def raw_repweights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replicate-weight file layout: (scram, week, pweight1..pweight80)."""
    k = F.col("o_orderkey")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey")
    pw = _pweight(k)
    return orders.select(
        F.concat(F.lit("V"), k.cast("string")).alias("scram"),
        _week(k).alias("week"),
        *[(pw * replicate_factor(k, r)).alias(f"pweight{r}")
          for r in range(1, N_REPLICATES + 1)])


def state_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State code table: (state_code, state, state_name) from ``nation``."""
    nation = read_table(spark, sf_dir, "nation")
    return (nation.select(F.col("n_nationkey").alias("state_code"),
                          F.col("n_name").alias("state"),
                          F.col("n_name").alias("state_name"))
            )


#: Race labels and their short names.
RACE_CROSSWALK = [(K.RACE_LABEL_WHITE, "white"), (K.RACE_LABEL_BLACK, "black"), (K.RACE_LABEL_ASIAN, "asian"),
                  (K.RACE_LABEL_HISPANIC, "hispanic"), (K.RACE_LABEL_OTHER, "other")]


def race_table(spark: SparkSession) -> DataFrame:
    """(label, race_var)."""
    return spark.createDataFrame(RACE_CROSSWALK, "label string, race_var string")


def metro_table(spark: SparkSession) -> DataFrame:
    """Metro code table: codes 0..14 in the fixed order of METRO_AREAS.

    ``csa_title`` stands in with the short metro name (no CSA file exists here).
    """
    rows = [(str(i), short, title) for i, (title, short, _) in enumerate(METRO_AREAS)]
    return spark.createDataFrame(rows, "cbsa_code string, csa_title string, cbsa_title string")

"""Query registry: one Spark callable and (where SQL-expressible) one DuckDB

Every Spark query reads the given tables (or data Spark derives from them)
in full; doubles are rounded to 9 digits only here, at the comparison
boundary, never inside the library.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repweave import constants as K
from repweave.functions import recode
from repweave.functions.scalar import round_doubles, sigdiff
from repweave.operators import estimate as E
from repweave.operators.design import ROLLING, ReplicateDesign
from repweave.operators.intervals import crosswalk, current_week, rolling_fanout
from repweave.operators.joins import row_count_guard
from repweave.plans import feature as FT
from repweave.plans import oracle as O
from repweave.plans import prepare as P
from repweave.session import compile_wide_stages
from repweave.sources import testdata as T

QueryFn = Callable[[SparkSession, str], DataFrame]
SPARK: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
            compile_wide_stages(spark)
            return round_doubles(fn(spark, sf_dir), 9)
        wrapped.__name__ = fn.__name__
        wrapped.__doc__ = fn.__doc__
        SPARK[name] = wrapped
        if sql is not None:
            SQL[name] = sql
        return wrapped
    return deco


def _sql(body: str) -> str:
    return "with " + O.prepared_ctes() + body


# ------------------------------------------------------------------ prepared --

def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.prepare(spark, sf_dir)


def est_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.estimation_input(prepared(spark, sf_dir))


def recoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recodes only (no replicate-weight join): what the recode queries need."""
    return P.recode_microdata(T.raw_microdata(spark, sf_dir))


def _value_counts(cols: list[str]) -> tuple[Callable, str]:
    def fn(spark, sf_dir):
        return recoded(spark, sf_dir).groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    c = ", ".join(cols)
    sql = _sql(f" select {c}, count(*) as n from rec group by {c}")
    return fn, sql


RECODE_GROUPS = {
    "recode_race": ["rrace", "rhispanic", "hisp_rrace"],
    "recode_uninsured": ["uninsured"],
    "recode_insured_public": ["insured_public"],
    "recode_income": ["inc_loss", "expect_inc_loss"],
    "recode_housing": ["payment_not_conf", "rent_not_conf", "mortgage_not_conf",
                       "rent_not_paid", "mortgage_not_paid"],
    "recode_food": ["food_insufficient"],
    "recode_classes": ["classes_cancelled"],
    "recode_stimulus": ["stimulus_expenses"],
    "recode_spend": ["spend_credit", "spend_savings", "spend_ui", "spend_stimulus"],
    "recode_mental_health": ["anxious_score", "worry_score", "interest_score", "down_score",
                             "anxiety_signs", "depression_signs", "depression_anxiety_signs"],
}
for _name, _cols in RECODE_GROUPS.items():
    _fn, _q = _value_counts(_cols)
    register(_name, _q)(_fn)


@register("recode_age_filter", _sql(
    " select uninsured, insured_public, count(*) as n from est group by uninsured, insured_public"))
def recode_age_filter(spark, sf_dir):
    """Insurance metrics after the age rule."""
    df = recoded(spark, sf_dir).withColumns({
        "uninsured": recode.age_rule("uninsured"),
        "insured_public": recode.age_rule("insured_public")})
    return df.groupBy("uninsured", "insured_public").agg(F.count(F.lit(1)).alias("n"))


_RACE_SUMS = ", ".join(
    f"cast(sum(case when hisp_rrace like '%{pat}%' then 1 else 0 end) as bigint) as {name}"
    for name, pat in K.RACE_PATTERNS.items())


@register("race_indicators", _sql(f" select week, {_RACE_SUMS}, count(*) as n from rec group by week"))
def race_indicators(spark, sf_dir):
    """0/1 race indicators (NULL label -> 0), summed per week."""
    df = recoded(spark, sf_dir)
    return df.groupBy("week").agg(
        *[F.sum(recode.race_indicator(g)).cast("bigint").alias(g) for g in K.RACE_PATTERNS],
        F.count(F.lit(1)).alias("n"))


# -------------------------------------------------------------------- enrich --

@register("enrich_state", _sql(
    " select est_st, state, state_name, count(*) as n from rec group by est_st, state, state_name"))
def enrich_state(spark, sf_dir):
    """State names by code (left join, broadcast behind a size check)."""
    return (survey_rows(spark, sf_dir).groupBy("est_st", "state", "state_name")
            .agg(F.count(F.lit(1)).alias("n")))


@register("enrich_metro", _sql(
    " select est_msa_s as est_msa, cbsa_title, csa_title, count(*) as n from rec"
    " group by est_msa_s, cbsa_title, csa_title"))
def enrich_metro(spark, sf_dir):
    """J2 + P28: metro names on the string code; NULL codes keep NULL names."""
    return (survey_rows(spark, sf_dir).groupBy("est_msa", "cbsa_title", "csa_title")
            .agg(F.count(F.lit(1)).alias("n")))


@register("enrich_weights", "with micro as (" + O.PROJECTION + f"""),
reps as (select m.week, m.o_orderkey, t.rep, {O.rep_weight_sql('t.rep')} as w
         from micro m cross join range(1, {K.N_REPLICATES + 1}) t(rep))
select week, count(distinct o_orderkey) as n, count(distinct o_orderkey) as n_with_weights,
       round(sum(w), 9) as repw_total, round(min(w), 9) as repw_min, round(max(w), 9) as repw_max
from reps group by week""")
def enrich_weights(spark, sf_dir):
    """Replicate weights joined on (week, scram); totals per week."""
    return _weight_totals(prepared(spark, sf_dir))


def _weight_totals(df):
    tot = F.aggregate("repw", F.lit(0.0), lambda a, v: a + v)
    return df.groupBy("week").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("repw").alias("n_with_weights"),
        F.sum(tot).alias("repw_total"),
        F.min(F.array_min("repw")).alias("repw_min"),
        F.max(F.array_max("repw")).alias("repw_max"))


@register("enrich_weights_bucketed", SQL["enrich_weights"])
def enrich_weights_bucketed(spark, sf_dir):
    """J3 on tables that were bucketed on (week, scram) at ingest: the join shuffles nothing."""
    import uuid
    from repweave.session import checkpoint_dir
    from repweave.sources.publish import write_bucketed
    base = f"{checkpoint_dir(spark).rstrip('/')}/repweave-{uuid.uuid4().hex}"
    keys, buckets = ["week", "scram"], max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    micro = write_bucketed(T.raw_microdata(spark, sf_dir).select("o_orderkey", *keys, "pweight"), f"{base}-micro", keys, buckets)
    repw = write_bucketed(P.repweights_array(T.raw_repweights(spark, sf_dir)), f"{base}-repw", keys, buckets)
    return _weight_totals(micro.join(repw.hint("merge"), keys, "left"))


@register("join_guard", "with micro as (" + O.PROJECTION + """)
select count(*) as rows_in, count(*) as rows_out, true as ok from micro""")
def join_guard(spark, sf_dir):
    """Prepare keeps exactly one row per raw respondent."""
    return row_count_guard(T.raw_microdata(spark, sf_dir), prepared(spark, sf_dir))


# ----------------------------------------------------------------- intervals --

@register("week_intervals", """
with mx as (select max(cast(((o_orderkey+1)*7919)%1000003%12+1 as int)) as n from orders),
s as (select cast(i as int) as interval_start from mx, range(1, mx.n) t(i))
select cast(interval_start as int) as week, 'wk' || interval_start as week_num,
       interval_start, 'wk' || interval_start || '_' || (interval_start + 1) as week_int from s
union all
select cast(interval_start + 1 as int) as week, 'wk' || (interval_start + 1) as week_num,
       interval_start, 'wk' || interval_start || '_' || (interval_start + 1) as week_int from s""")
def week_intervals(spark, sf_dir):
    """W1 + S18: overlapping two-week crosswalk for the current week."""
    n = current_week(T.raw_microdata(spark, sf_dir).select("week"))
    return crosswalk(spark, n)


@register("rolling_fanout", _sql("""
, mx as (select max(week) as n from est)
select 'wk' || i || '_' || (i + 1) as week_num, cast(i as int) as interval_start,
       count(*) as n, round(sum(pweight * 0.5), 9) as pweight_half
from est, mx, (select unnest([week - 1, week]) as i) u
where i >= 1 and i <= mx.n - 1
group by i"""))
def rolling_fanout_q(spark, sf_dir):
    """J4 + P36: each respondent row in the (up to two) intervals containing its week."""
    df = survey_rows(spark, sf_dir)
    n = current_week(T.raw_microdata(spark, sf_dir).select("week"))
    fan = rolling_fanout(df, n)
    return (fan.groupBy("week_num", "interval_start")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.sum(F.col("pweight") * 0.5).alias("pweight_half")))


# ---------------------------------------------------------- drift / distinct --

@register("schema_drift_union", "with micro as (" + O.PROJECTION + """)
select week, count(*) as n, count(eip) as n_eip, count(spndsrc1) as n_spndsrc1
from micro group by week""")
def schema_drift_union(spark, sf_dir):
    """S3 + P2 + U1: early weeks lack eip/spndsrc*; stack by name, missing -> NULL."""
    raw = T.raw_microdata(spark, sf_dir)
    early = raw.where(F.col("week") < K.DRIFT_FIRST_WEEK).drop(*K.DRIFT_COLUMNS)
    late = raw.where(F.col("week") >= K.DRIFT_FIRST_WEEK)
    stacked = late.unionByName(early, allowMissingColumns=True)
    return stacked.groupBy("week").agg(F.count(F.lit(1)).alias("n"),
                                       F.count("eip").alias("n_eip"),
                                       F.count("spndsrc1").alias("n_spndsrc1"))


@register("distinct_respondents", _sql("""
select week, count(*) as n_distinct from (select distinct scram, week from rec) d group by week"""))
def distinct_respondents(spark, sf_dir):
    """Distinct (scram, week); respondent ids are only unique within a week."""
    return (prepared(spark, sf_dir).select("scram", "week").distinct()
            .groupBy("week").agg(F.count(F.lit(1)).alias("n_distinct")))


@register("current_week", """
select max(cast(((o_orderkey+1)*7919)%1000003%12+1 as int)) as current_week,
       count(*) as n_rows from orders""")
def current_week_q(spark, sf_dir):
    """Latest week and row count, as one aggregate."""
    return T.raw_microdata(spark, sf_dir).agg(F.max("week").alias("current_week"),
                                             F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------- estimators --

def _one_sided_sql(keys_sel: str, keys: str, factor: float, mse: bool,
                   source: str = "lng") -> str:
    """National one-sided mean/SE grouped by ``keys``."""
    centre = "c.m" if mse else "c.mr"
    return f""",
s1 as (select {keys_sel}, metric, rep, sum(w) as sw, sum(w * x) as swx, count(*) as n
       from {source} group by all),
t1 as (select {keys}, metric, rep, n, swx / nullif(sw, 0) as t from s1),
c1 as (select {keys}, metric, max(case when rep = 0 then n end) as n,
              max(case when rep = 0 then t end) as m, avg(case when rep > 0 then t end) as mr
       from t1 group by all)
select {keys}, metric, round(c.m, 9) as mean,
       round(2 * sqrt(coalesce(sum(case when t.rep > 0 then power(t.t - {centre}, 2) end), 0) / {K.N_REPLICATES}), 9) as se,
       c.n as n
from t1 t join c1 c using ({keys}, metric) group by {keys}, metric, c.m, c.mr, c.n"""


def _week_long_sql(factor: float) -> str:
    """CTE lng over single weeks (no interval fan-out)."""
    m = O.metric_list(K.METRICS)
    return f""",
unp as (select o_orderkey, pweight, week, hisp_rrace, metric, x
        from (unpivot (select o_orderkey, pweight, week, hisp_rrace, {m} from est)
              on {m} into name metric value x)),
lng as (select u.*, t.rep, ({O.rep_weight_sql('t.rep', 'u.o_orderkey', 'u.pweight')}) * {factor} as w
        from unp u cross join range(0, {K.N_REPLICATES + 1}) t(rep))"""


def _svy_mean(design: ReplicateDesign):
    def fn(spark, sf_dir):
        from repweave.operators.cube import sufficient_stats
        cube = sufficient_stats(est_input(spark, sf_dir), design, K.METRICS, ["week"])
        return E.finish_one_sided(cube, design, ["week"], K.METRICS)
    return fn


register("svy_mean", "with " + O.prepared_ctes() + _week_long_sql(1.0)
         + _one_sided_sql("week", "week", 1.0, True))(_svy_mean(ReplicateDesign()))
register("svy_mean_mse_false", "with " + O.prepared_ctes() + _week_long_sql(1.0)
         + _one_sided_sql("week", "week", 1.0, False))(_svy_mean(ReplicateDesign(mse=False)))


@register("svy_mean_by_race", "with " + O.prepared_ctes() + "," + O.long_ctes(K.METRICS).replace(
    "select o_orderkey, pweight, interval_start, state, cbsa_title, race, ",
    "select o_orderkey, pweight, interval_start, hisp_rrace, ").replace(
    "select o_orderkey, pweight, interval_start, state, cbsa_title, race, metric, x",
    "select o_orderkey, pweight, interval_start, hisp_rrace, metric, x")
    + _one_sided_sql("interval_start, hisp_rrace", "interval_start, hisp_rrace", 0.5, True))
def svy_mean_by_race(spark, sf_dir):
    """Rolling national mean and SE by race label (NULL label is its own group)."""
    from repweave.operators.cube import sufficient_stats, to_intervals
    ei = est_input(spark, sf_dir)
    wc = FT.materialize(sufficient_stats(ei, ROLLING, K.METRICS, ["week", "hisp_rrace"]))
    cube = to_intervals(wc, current_week(wc))
    out = E.finish_one_sided(cube, ROLLING, ["interval_start", "hisp_rrace"], K.METRICS)
    return out.withColumn("interval_start", F.col("interval_start").cast("int"))


@register("us_total", "with " + O.prepared_ctes() + "," + O.long_ctes(K.METRICS) + ","
          + O.us_total_ctes() + """
select week_num, interval_start, metric, round(mean, 9) as mean, round(se, 9) as se, n from ust_out""")
def us_total_q(spark, sf_dir):
    """A10: national rolling mean + SE (x2) per interval over non-NULL rows."""
    from repweave.operators.cube import sufficient_stats, to_intervals
    ei = est_input(spark, sf_dir)
    wc = FT.materialize(sufficient_stats(ei, ROLLING, K.METRICS, ["week"]))
    cube = to_intervals(wc, current_week(wc))
    return E.finish_one_sided(cube, ROLLING, ["week_num", "interval_start"], K.METRICS)


def _estimates(spark, sf_dir) -> FT.Estimates:
    return FT.estimate(est_input(spark, sf_dir))


def _contrast(fam_filter, source: str):
    def fn(spark, sf_dir):
        est = _estimates(spark, sf_dir)
        df = est.national if source == "national" else est.geo
        return df.where(fam_filter()).select(*O.ESTIMATE_OUT)
    return fn


register("contrast_race_state", O.estimates_sql(["state_race"]))(_contrast(
    lambda: (F.col("geo_type") == "state") & (F.col("race_indicator") != "total"), "geo"))
register("contrast_race_metro", O.estimates_sql(["msa_race"]))(_contrast(
    lambda: (F.col("geo_type") == "msa") & (F.col("race_indicator") != "total"), "geo"))
register("contrast_geo_total", O.estimates_sql(["state_total", "msa_total"]))(_contrast(
    lambda: F.col("race_indicator") == "total", "geo"))
register("contrast_race_us", O.estimates_sql(["us_race"]))(_contrast(
    lambda: F.lit(True), "national"))


FEATURE_DOUBLES = ["mean", "se", "moe_95", "moe_95_lb", "moe_95_ub"]


def _feature_sql(final: str, metrics: list[str] = K.METRICS) -> str:
    fams = ["state_race", "msa_race", "us_race", "state_total", "msa_total"]
    two = " union all ".join(
        f"select metric, race_indicator as race_var, week_num, geography, mean, se, geo_type, "
        f"diff_mean, diff_se from {n}_out" for n in fams)
    dates = ", ".join(f"({O._sq(a)}, {O._sq(b)})" for a, b in K.INTERVAL_DATES)
    return ("with " + O.families_sql(fams, metrics, cube=True) + "," + O.us_total_ctes(metrics, cube=True) + f""",
rows2 as ({two}),
feat as (
  select metric, race_var, week_num, geography, mean, se, geo_type,
         se * 1.96 as moe_95, mean - se * 1.96 as moe_95_lb, mean + se * 1.96 as moe_95_ub,
         case when diff_se = 0 and diff_mean = 0 then null when diff_se = 0 then 1
              when abs(diff_mean / diff_se) > 1.96 then 1 else 0 end as sigdiff
  from rows2
  union all
  select metric, 'total' as race_var, week_num, 'US' as geography, mean, se, 'national' as geo_type,
         se * 1.96, mean - se * 1.96, mean + se * 1.96, cast(null as int) from ust_out
),
ft as (select f.*, d.date_int from feat f left join (values {dates}) d(week_num, date_int) using (week_num))
""" + final)


@register("feature_table", _feature_sql(
    "select " + O.rounded(FT.FEATURE_COLS, FEATURE_DOUBLES) + " from ft"))
def feature_table_q(spark, sf_dir):
    """A13 + A14 + A10 + P43 + P44 + U1 + J8 + O1: the published feature table."""
    return FT.feature_table(_estimates(spark, sf_dir))


_SAMPLE_SQL = _feature_sql("select " + O.rounded(FT.FEATURE_COLS, FEATURE_DOUBLES) + """ from ft
order by md5('42|' || metric || '|' || race_var || '|' || geography || '|' || week_num), metric, race_var, geography, week_num
limit 10""")


@register("sigdiff_count", _feature_sql("""
select metric, geo_type, count(*) as n_cells, count(sigdiff) as n_tested,
       cast(coalesce(sum(sigdiff), 0) as bigint) as n_sigdiff from ft group by metric, geo_type"""))
def sigdiff_count(spark, sf_dir):
    """Significant differences per metric and geography type."""
    ft = FT.feature_table(_estimates(spark, sf_dir), sort=False)
    return ft.groupBy("metric", "geo_type").agg(
        F.count(F.lit(1)).alias("n_cells"), F.count("sigdiff").alias("n_tested"),
        F.coalesce(F.sum("sigdiff"), F.lit(0)).cast("bigint").alias("n_sigdiff"))


_GEO_FAMILIES = ["state_race", "msa_race", "us_race", "state_total", "msa_total"]


@register("sigdiff_versions", "with " + O.families_sql(_GEO_FAMILIES, cube=True) + ", o as ("
          + " union all ".join(f"select * from {f}_out" for f in _GEO_FAMILIES) + """),
f as (select metric, geo_type,
        case when diff_se = 0 and diff_mean = 0 then null when diff_se = 0 then true
             else abs(diff_mean / diff_se) > 1.96 end as new_sig,
        case when mean is null then null when se = 0 and other_se = 0 then (case when diff_mean = 0 then null else true end)
             else abs(diff_mean) / sqrt(se * se + 4 * other_se * other_se) > 1.96 end as old_sig from o)
select metric, geo_type, count(*) as n_cells, count(*) filter (new_sig) as n_new, count(*) filter (old_sig) as n_old,
       count(*) filter (new_sig and not old_sig) as n_new_only, count(*) filter (old_sig and not new_sig) as n_old_only
from f group by metric, geo_type""")
def sigdiff_versions(spark, sf_dir):
    """Flagged differences by two measures side by side: the replicate error of the
    difference (new), and the two sides' own errors as if they were independent (old)."""
    est = _estimates(spark, sf_dir)
    rows = est.geo.unionByName(est.national)
    new = sigdiff(F.col("diff_mean"), F.col("diff_se"))
    apart = F.sqrt(F.col("se") * F.col("se") + 4 * F.col("other_se") * F.col("other_se"))
    old = F.when(F.col("mean").isNotNull(), sigdiff(F.col("diff_mean"), apart))
    both = rows.select("metric", "geo_type", new.alias("new"), old.alias("old"))
    only = lambda x, y: F.count(F.when((F.col(x) == 1) & (F.col(y) == 0), 1))
    return both.groupBy("metric", "geo_type").agg(
        F.count(F.lit(1)).alias("n_cells"), F.count(F.when(F.col("new") == 1, 1)).alias("n_new"),
        F.count(F.when(F.col("old") == 1, 1)).alias("n_old"), only("new", "old").alias("n_new_only"),
        only("old", "new").alias("n_old_only"))


@register("text_helpers", _sql(f"""
, t as (select week, hisp_rrace, cbsa_title, state, pweight,
               'micro_' || case when length(cast(week as varchar)) >= 2 then cast(week as varchar) else '0' || week end || '.csv' as file
        from rec)
select file, count(*) filter (not contains(hisp_rrace, 'not Hispanic')) as n_hispanic,
       count(*) filter (pweight between 550 - 50.5 and 550 + 50.5) as n_near,
       count(*) filter (cbsa_title is not null and cbsa_title <> 'US' and length(cbsa_title) <> 2) as n_msa,
       count(*) filter (length(left(state, 2)) = 2) as n_state, cast(sum(length(cbsa_title)) as bigint) as n_chars
from t group by file"""))
def text_helpers(spark, sf_dir):
    """Padded file names, lengths, tolerance, negated match, and
    the geography type by shape (on two-letter state codes, as it is meant for)."""
    from repweave.functions.scalar import geo_type_by_shape, within
    from repweave.sources.files import week_file_name
    d = survey_rows(spark, sf_dir).withColumn("file", week_file_name("micro", F.col("week")))
    count = lambda c: F.count(F.when(c, 1))
    return d.groupBy("file").agg(
        count(~F.col("hisp_rrace").contains("not Hispanic")).alias("n_hispanic"),
        count(within(F.col("pweight"), F.lit(550.0), 50.5)).alias("n_near"),
        count(F.col("cbsa_title").isNotNull() & (geo_type_by_shape(F.col("cbsa_title")) == "msa")).alias("n_msa"),
        count(geo_type_by_shape(F.substring("state", 1, 2)) == "state").alias("n_state"),
        F.sum(F.length("cbsa_title")).alias("n_chars"))


# ----------------------------------------------------------------- regression --

def _national_race_sides(spark, sf_dir):
    """National (interval, race, rep) cube with race-complement sums."""
    from repweave.operators.cube import sufficient_stats, to_intervals
    ei = est_input(spark, sf_dir)
    wc = FT.materialize(sufficient_stats(ei, ROLLING, K.METRICS, ["week", "race"]), "race-cube")
    ic = to_intervals(wc, current_week(wc))
    sides = E.with_complement(ic, ["interval_start", "week_num", "rep"], "race", K.METRICS)
    return (sides.where(F.col("race").isin(*K.RACE_GROUPS))
            .withColumnRenamed("race", "race_indicator"))


_GLM_SQL = "with " + O.prepared_ctes() + "," + O.long_ctes(K.METRICS) + f""",
cls as (select interval_start, metric, race, rep, count(*) as n, sum(w) as sw, sum(w * x) as swx
        from lng group by all),
tg as (select * from (values {", ".join(f"('{g}')" for g in K.RACE_GROUPS)}) v(race_indicator)),
xr as (select c.interval_start, c.metric, tg.race_indicator, c.rep, c.n, c.sw, c.swx,
              case when c.race = tg.race_indicator then 1.0 else 0.0 end as xi
       from cls c cross join tg),
s as (select interval_start, metric, race_indicator, rep, sum(n) as n, sum(sw) as s,
             sum(sw * xi) as sx, sum(swx) as sy, sum(sw * xi * xi) as sxx, sum(swx * xi) as sxy
      from xr group by all),
b as (select *, (s * sxy - sx * sy) / nullif(s * sxx - sx * sx, 0) as b from s),
a as (select *, (sy - b * sx) / nullif(s, 0) as a from b),
c0 as (select interval_start, metric, race_indicator, n, a as a0, b as b0 from a where rep = 0)
select c0.metric, c0.race_indicator, 'wk' || c0.interval_start || '_' || (c0.interval_start + 1) as week_num,
       round(c0.a0, 9) as intercept, round(c0.b0, 9) as slope,
       round(2 * sqrt(coalesce(sum(power(a.b - c0.b0, 2)), 0) / {K.N_REPLICATES}), 9) as slope_se,
       cast(c0.n as bigint) as n
from a join c0 using (interval_start, metric, race_indicator) where a.rep > 0
group by c0.interval_start, c0.metric, c0.race_indicator, c0.a0, c0.b0, c0.n"""


@register("svy_glm", _GLM_SQL)
def svy_glm_q(spark, sf_dir):
    """Weighted regression metric ~ 1{race group}, national, per interval;
    replicate SE of the slope (x2). Closed form from merged sums."""
    from repweave.operators.regression import fit_from_sums
    sides = _national_race_sides(spark, sf_dir)
    keys = ["week_num", "race_indicator"]
    structs = []
    for m in K.METRICS:
        a_sw, b_sw = F.col(f"a_sw__{m}"), F.col(f"b_sw__{m}")
        a_swx, b_swx = F.col(f"a_swx__{m}"), F.col(f"b_swx__{m}")
        structs.append(F.struct(F.lit(m).alias("metric"),
                                (F.col(f"a_n__{m}") + F.col(f"b_n__{m}")).alias("n"),
                                (a_sw + b_sw).alias("s"), a_sw.alias("sx"),
                                (a_swx + b_swx).alias("sy"), a_sw.alias("sxx"), a_swx.alias("sxy")))
    long = sides.select(*keys, "rep", F.inline(F.array(*structs)))
    return fit_from_sums(long, ROLLING, [*keys, "metric"]).where(F.col("n") > 0)


def check_glm(spark, sf_dir):
    """|regression slope| and its SE equal |diff_mean| and diff_se (4 digits), every race
    cell of states, metros and the nation; both come from one cube."""
    from repweave.operators.regression import fit_from_sums
    est = _estimates(spark, sf_dir)
    g = est.cube.where(F.col("by_race")).drop("by_race")
    at = ["interval_start", "geo_type", "geography"]
    sides = E.with_complement(g, [*at, "rep"], "race", K.METRICS)
    sides = sides.where(F.col("race").isin(*K.RACE_GROUPS) & F.col("geography").isNotNull())
    long = sides.select(*at, F.col("race").alias("race_indicator"), "rep", F.inline(F.array(*[F.struct(
        F.lit(m).alias("metric"), (F.col(f"a_n__{m}") + F.col(f"b_n__{m}")).alias("n"),
        (F.col(f"a_sw__{m}") + F.col(f"b_sw__{m}")).alias("s"), F.col(f"a_sw__{m}").alias("sx"),
        (F.col(f"a_swx__{m}") + F.col(f"b_swx__{m}")).alias("sy"), F.col(f"a_sw__{m}").alias("sxx"),
        F.col(f"a_swx__{m}").alias("sxy")) for m in K.METRICS])))
    keys = [*at, "race_indicator", "metric"]
    glm = fit_from_sums(long, ROLLING, keys)
    cells = est.geo.where("race_indicator <> 'total'").unionByName(est.national)
    j = cells.select(*keys, "week_num", "diff_mean", "diff_se").join(glm.select(*keys, "slope", "slope_se"), keys, "left")
    r4 = lambda c: F.round(c, 4)
    known = F.col("slope").isNotNull()
    return j.select("geo_type", "geography", "week_num", "race_indicator", "metric", "slope",
                    F.when(known, F.col("slope_se")).alias("slope_se"), "diff_mean", "diff_se",
                    F.when(known, (r4(F.abs("slope")) == r4(F.abs("diff_mean")))
                           & (r4("slope_se") == r4("diff_se"))).alias("ok"))


# ------------------------------------------------------------------------ EDA --

@register("hh_size_by_race", _sql("""
select week, hisp_rrace, case when count(thhld_numper) = count(*) then avg(thhld_numper) end as mean,
       count(*) as n
from (select distinct scram, week, hisp_rrace, thhld_numper from rec) d group by week, hisp_rrace"""))
def hh_size_by_race(spark, sf_dir):
    """A17 + A19: mean household size by week and race label over distinct respondents."""
    from repweave.operators.reshape import group_mean
    d = survey_rows(spark, sf_dir).dropDuplicates(["scram", "week"])
    return group_mean(d, ["week", "hisp_rrace"], "thhld_numper")


@register("hh_size_by_geo", _sql("""
, d as (select distinct scram, week, state, cbsa_title, thhld_numper from rec)
select week, 'state' as geo_type, state as geography,
       case when count(thhld_numper) = count(*) then avg(thhld_numper) end as mean, count(*) as n
from d group by week, state
union all
select week, 'msa' as geo_type, cbsa_title as geography,
       case when count(thhld_numper) = count(*) then avg(thhld_numper) end as mean, count(*) as n
from d group by week, cbsa_title"""))
def hh_size_by_geo(spark, sf_dir):
    """Mean household size by week and state, and by week and metro (NULL = no metro)."""
    from repweave.operators.reshape import mean_strict
    d = survey_rows(spark, sf_dir).dropDuplicates(["scram", "week"])
    g = d.groupingSets([["week", "state"], ["week", "cbsa_title"]], "week", "state", "cbsa_title").agg(
        F.grouping("state").alias("_gs"), mean_strict("thhld_numper").alias("mean"), F.count(F.lit(1)).alias("n"))
    by_state = F.col("_gs") == 0
    return g.select("week", F.when(by_state, "state").otherwise("msa").alias("geo_type"),
                    F.when(by_state, F.col("state")).otherwise(F.col("cbsa_title")).alias("geography"), "mean", "n")


@register("ratio_of_sums", _sql("""
select week, state, sum(pweight * inc_loss) as sum_num,
       sum(case when inc_loss is not null then pweight end) as sum_den,
       sum(pweight * inc_loss) / nullif(sum(case when inc_loss is not null then pweight end), 0) as ratio
from rec group by week, state"""))
def ratio_of_sums_q(spark, sf_dir):
    """Weighted count over weighted base per week and state."""
    from repweave.operators.reshape import ratio_of_sums
    from repweave.operators.joins import left_lookup
    d = left_lookup(recoded(spark, sf_dir), T.state_table(spark, sf_dir), "est_st", "state_code", max_rows=10_000)
    return ratio_of_sums(d, ["week", "state"], F.col("pweight") * F.col("inc_loss"),
                         F.when(F.col("inc_loss").isNotNull(), F.col("pweight")))


# -------------------------------------------------------------- reshape/grid --

@register("unpivot_metrics", _sql(f"""
select week, metric, value, count(*) as n
from (unpivot (select week, {O.metric_list(K.METRICS)} from est)
      on {O.metric_list(K.METRICS)} into name metric value value)
group by week, metric, value"""))
def unpivot_metrics_q(spark, sf_dir):
    """The 16 metric columns stacked to (metric, value), NULLs dropped."""
    from repweave.operators.reshape import unpivot_metrics
    long = unpivot_metrics(P.estimation_input(survey_rows(spark, sf_dir)), ["week"], K.METRICS)
    return long.groupBy("week", "metric", "value").agg(F.count(F.lit(1)).alias("n"))


def _vals(col, items):
    return "(select * from (values " + ", ".join(f"({O._sq(str(x))})" for x in items) + f") v({col}))"


@register("grid", _sql(f"""
, mx as (select max(week) as nw from est),
geos as (select distinct 'state' as geo_type, state as geography from est where state is not null
         union select distinct 'msa', cbsa_title from est where cbsa_title is not null)
select g.geo_type, g.geography, m.metric, r.race_indicator,
       'wk' || i.s || '_' || (i.s + 1) as week_num
from geos g, mx, range(1, mx.nw) i(s), {_vals('metric', K.METRICS)} m,
     {_vals('race_indicator', K.RACE_INDICATORS)} r"""))
def grid_q(spark, sf_dir):
    """Metric x race indicator x geography x interval skeleton of the feature table."""
    from repweave.functions.scalar import interval_label
    from repweave.operators.reshape import literal_grid
    raw = T.raw_microdata(spark, sf_dir)
    n = current_week(raw.select("week"))
    # both names of a row in one pass
    geos = (survey_rows(spark, sf_dir)
            .select(F.inline(F.array(F.struct(F.lit("state").alias("geo_type"), F.col("state").alias("geography")),
                                     F.struct(F.lit("msa").alias("geo_type"), F.col("cbsa_title").alias("geography")))))
            .where(F.col("geography").isNotNull()).distinct())
    g = literal_grid(geos, {"metric": K.METRICS, "race_indicator": K.RACE_INDICATORS,
                            "s": list(range(1, n))})
    return g.select("geo_type", "geography", "metric", "race_indicator",
                    interval_label(F.col("s")).alias("week_num"))


@register("pad_missing_cells", "with " + O.prepared_ctes() + "," + O.long_ctes(K.METRICS) + ","
          + O.us_total_ctes() + f""",
gr as (select m.metric, cast(i.s as int) as interval_start, 'wk' || i.s || '_' || (i.s + 1) as week_num
       from mxw, range(1, mxw.nw) i(s), {_vals('metric', K.METRICS)} m)
select gr.week_num, gr.interval_start, gr.metric, round(u.mean, 9) as mean, round(u.se, 9) as se, u.n
from gr left join ust_out u using (metric, interval_start)""")
def pad_missing_cells(spark, sf_dir):
    """National totals padded to every metric x interval; no-data cells get NULLs."""
    from repweave.functions.scalar import interval_label
    from repweave.operators.reshape import literal_grid, pad_missing
    present = SPARK["us_total"](spark, sf_dir)
    n = current_week(T.raw_microdata(spark, sf_dir).select("week"))
    base = spark.range(1).select(F.lit(1).alias("_k"))
    g = literal_grid(base, {"metric": K.METRICS, "interval_start": list(range(1, n))})
    g = g.select("metric", "interval_start", interval_label(F.col("interval_start")).alias("week_num"))
    return pad_missing(g, present, ["metric", "interval_start", "week_num"])


@register("one_hot_state", _sql("""
, weeks as (select distinct week from rec), sts as (select distinct state from rec)
select w.week, 'state_' || trim(regexp_replace(lower(trim(s.state)), '[^0-9a-z]+', '_', 'g'), '_') as dummy,
       (select count(*) from rec r where r.week = w.week and r.state = s.state) as n_ones
from weeks w, sts s"""))
def one_hot_state(spark, sf_dir):
    """One-hot state columns; reported as ones per (week, dummy column)."""
    from repweave.operators.reshape import one_hot
    d = survey_rows(spark, sf_dir).select("week", "state")
    oh = one_hot(d, "state")
    dummies = [c for c in oh.columns if c.startswith("state_")]
    long = oh.unpivot(["week"], dummies, "dummy", "v")
    return long.groupBy("week", "dummy").agg(F.sum("v").cast("bigint").alias("n_ones"))


@register("sample_cells", _SAMPLE_SQL)
def sample_cells(spark, sf_dir):
    """O3: a seeded sample of 10 feature-table cells, the first by MD5 of seed and keys."""
    from repweave.operators.reshape import sample_rows
    ft = FT.feature_table(_estimates(spark, sf_dir), sort=False)
    return sample_rows(ft, 10, 42, ["metric", "race_var", "geography", "week_num"])


@register("frame_diff", """
with mx as (select max(cast(((o_orderkey+1)*7919)%1000003%12+1 as int)) as n from orders)
select 'wk' || i || '_' || (i + 1) as week_num, cast(i as int) as interval_start, 'inc_loss' as metric, side
from mx, (values (1, 'both'), (2, 'left_only')) v(i, side) where i < n""")
def frame_diff_q(spark, sf_dir):
    """National totals from the geo cube vs from the direct week cube, with one value
    changed and one row left out of the second: exactly these two are reported."""
    from repweave.operators.reshape import frame_diff
    gc, _ = FT.geo_cube_of(est_input(spark, sf_dir))
    a = E.us_total(gc, ROLLING).select("week_num", "interval_start", "metric", "mean", "se", "n")
    b = SPARK["us_total"](spark, sf_dir).select(*a.columns)
    at = lambda i: (F.col("metric") == "inc_loss") & (F.col("interval_start") == i)
    b = b.where(~at(2)).withColumn("mean", F.when(at(1), F.col("mean") + 1e-6).otherwise(F.col("mean")))
    return frame_diff(a, b, ["week_num", "interval_start", "metric"])


# ------------------------------------------------------------ published tables --

def survey_rows(spark, sf_dir):
    """Recoded respondents with state and metro names (no replicate weights)."""
    from repweave.operators.joins import left_lookup
    r = recoded(spark, sf_dir)
    r = left_lookup(r, T.state_table(spark, sf_dir), "est_st", "state_code", max_rows=10_000)
    return left_lookup(r, T.metro_table(spark), "est_msa", "cbsa_code", known_rows=len(K.METRO_AREAS))


def _normalise_sql(spec) -> str:
    q = O._sq
    metro_sheet = "case " + " ".join(f"when cbsa_title = {q(t)} then {q(sh)}"
                                     for t, _, sh in K.METRO_AREAS) + " end"
    metro_title = "case " + " ".join(f"when sheet = {q(sh)} then {q(t)}"
                                     for t, _, sh in K.METRO_AREAS) + " end"
    race_short = ("case " + " ".join(f"when variable = {q(lab)} then {q(n)}" for lab, n in [
        (K.RACE_LABEL_HISPANIC, "hispanic"), (K.RACE_LABEL_WHITE, "white"),
        (K.RACE_LABEL_BLACK, "black"), (K.RACE_LABEL_ASIAN, "asian"),
        (K.RACE_LABEL_OTHER, "other")]) + " else variable end")
    sums = ", ".join(f"sum(case when {pred} then pweight end) as {c}" for c, pred in spec.counts.items())
    zero = ", ".join(f"coalesce({c}, 0) as {c}" for c in spec.counts)
    derived = ", ".join(f"{expr} as {c}" for c, expr in spec.derived.items())
    keep = ", ".join(f"round({c}, 9) as {c}" for c in spec.keep)
    return _sql(f"""
, src as (select *, {metro_sheet} as metro_sheet from rec
          where ({spec.universe}) and week >= {spec.first_week} and hisp_rrace is not null),
cells as (
  select week, state as sheet, hisp_rrace as variable, {sums} from src where state is not null
  group by week, state, hisp_rrace
  union all
  select week, metro_sheet, hisp_rrace, {sums} from src where metro_sheet is not null
  group by week, metro_sheet, hisp_rrace
  union all
  select week, 'US', hisp_rrace, {sums} from src group by week, hisp_rrace
),
z as (select week, sheet, variable, {zero} from cells),
d as (select *, {derived} from z)
select variable, case when sheet like '%Metro_Area%' then {metro_title} else sheet end as geography,
       {keep}, 'wk' || week as week_num, {race_short} as race_var
from d""")


def _normalise_q(spec):
    def fn(spark, sf_dir):
        from repweave.operators.published import cell_table, normalise, positional
        return normalise(positional(cell_table(survey_rows(spark, sf_dir), spec), spec), spec)
    fn.__doc__ = f"T-normaliser for published table {spec.name} (cells derived from the microdata)."
    return fn


def _register_normalisers():
    from repweave.operators.published import SPECS
    for name, spec in SPECS.items():
        register(f"normalise_{name}", _normalise_sql(spec))(_normalise_q(spec))


_register_normalisers()


def _normalise_all_sql() -> str:
    from repweave.operators.published import SPECS
    each = ", ".join(f"n_{name} as ({_normalise_sql(spec)})" for name, spec in SPECS.items())
    return f"with {each} " + " union all ".join(
        f"""select '{name}' as "table", variable, geography, week_num, race_var, '{k}' as measure, cast({k} as double) as value
from n_{name}""" for name, spec in SPECS.items() for k in spec.keep)


def normalise_all(spark, sf_dir):
    """All fourteen published tables from one mixed cell table, each row by the spec that its table names."""
    from repweave.operators.published import SPECS, cell_tables, dispatch
    return dispatch(cell_tables(survey_rows(spark, sf_dir), SPECS.values()))


register("normalise_all", _normalise_all_sql())(normalise_all)


_RACE_XWALK_SQL = ", ".join(f"({O._sq(label)}, '{name}')" for label, name in T.RACE_CROSSWALK)


@register("race_label_join", _sql(f"""
, x(label, race_var) as (values {_RACE_XWALK_SQL})
select week, hisp_rrace, race_var, count(*) as n, round(sum(pweight), 6) as weight
from rec left join x on hisp_rrace = label group by all"""))
def race_label_join(spark, sf_dir):
    """Short race names joined to respondents by their label; labels without a name stay."""
    from repweave.operators.joins import left_lookup
    named = left_lookup(recoded(spark, sf_dir), T.race_table(spark), "hisp_rrace", "label", known_rows=len(T.RACE_CROSSWALK))
    return named.groupBy("week", "hisp_rrace", "race_var").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("pweight"), 6).alias("weight"))


def _published_parts():
    """(spec, metric, numerator, denominator) of every published metric that is checked."""
    from repweave.operators.published import SPECS
    out = []
    for spec in SPECS.values():
        if spec.metric is not None:
            out.append((spec, spec.metric, spec.numerator, spec.denominator))
            if "second" in spec.extra:
                out.append((spec, *spec.extra["second"]))
    return out


def _check_published_sql() -> str:
    """Estimates by plain grouping of full weights (no replicates: means only), published
    ratios from the normalisers' own SQL, and a full join."""
    parts = _published_parts()
    metrics = [m for _, m, _, _ in parts]
    # each normaliser's query keeps its own WITH clause as a derived table
    pub = " union all ".join(
        f"select week_num as wk, geography, race_var, '{m}' as metric, {num} as num, {den} as den from n_{spec.name}"
        for spec, m, num, den in parts)
    norm = ", ".join(f"n_{spec.name} as ({_normalise_sql(spec)})" for spec in {p[0].name: p[0] for p in parts}.values())
    long = " union all ".join(
        f"select week, state, cbsa_title, race, pweight as w, '{m}' as metric, {m} as x from est where {m} is not null"
        for m in metrics)
    fams = " union all ".join(f"""
select interval_start, {geo} as geography, '{t}' as geo_type, metric, race, sum(w) as sw, sum(w * x) as swx, count(*) as n
from fan {"where " + geo + " is not null" if geo != "'US'" else ""} group by all"""
                              for t, geo in (("state", "state"), ("msa", "cbsa_title"), ("national", "'US'")))
    races = ", ".join(f"('{g}')" for g in K.RACE_GROUPS)
    names = ", ".join(f"('{m}')" for m in metrics)
    return "with " + O.prepared_ctes() + f""",
{norm},
mx as (select max(week) as nw from est),
pub0 as ({pub}),
iv as (select 'wk' || (s + d) as wk, 'wk' || s || '_' || (s + 1) as week_int
       from mx, range(1, mx.nw) t(s), range(0, 2) u(d)),
pubs as (select coalesce(week_int, wk) as week_num, geography, race_var, metric, sum(num) / nullif(sum(den), 0) as published_mean,
                count(distinct wk) as n_weeks
         from pub0 left join iv using (wk) group by 1, 2, 3, 4),
lg as ({long}),
fan as (select lg.*, week - d as interval_start from lg, mx, range(0, 2) u(d) where week - d between 1 and nw - 1),
cell as ({fams}),
-- of the whole geography, and of all geographies together, for the empty-cell rule
geo as (select interval_start, geography, geo_type, metric, sum(sw) as sw, sum(swx) as swx, sum(n) as n from cell group by all),
nat as (select interval_start, metric, sum(n) as n, sum(sw) as sw, sum(swx) as swx from cell where geo_type = 'national' group by all),
geos as (select distinct geography, geo_type from cell),
grid as (select geography, geo_type, interval_start, metric from geos, mx, range(1, mx.nw) t(interval_start), (values {names}) v(metric)),
est_race as (
  select g.geography, g.interval_start, r.race_var, g.metric,
         case when coalesce(c.n, 0) = 0 or coalesce(geo.n, 0) = c.n then null else c.swx / c.sw end as mean
  from grid g cross join (values {races}) r(race_var)
  left join cell c on c.geography = g.geography and c.geo_type = g.geo_type and c.interval_start = g.interval_start
                  and c.metric = g.metric and c.race = r.race_var
  left join geo on geo.geography = g.geography and geo.geo_type = g.geo_type and geo.interval_start = g.interval_start
               and geo.metric = g.metric),
est_total as (
  select g.geography, g.interval_start, 'total' as race_var, g.metric,
         case when g.geo_type <> 'national' and (coalesce(geo.n, 0) = 0 or geo.n = nat.n) then null else geo.swx / geo.sw end as mean
  from grid g left join geo using (geography, geo_type, interval_start, metric)
  left join nat on nat.interval_start = g.interval_start and nat.metric = g.metric
  where g.geo_type <> 'national' or geo.n is not null),
ests as (select geography, 'wk' || interval_start || '_' || (interval_start + 1) as week_num, race_var, metric, mean, 1 as e
         from (select * from est_race union all select * from est_total)),
j as (select coalesce(a.geography, b.geography) as geography, coalesce(a.week_num, b.week_num) as week_num,
             coalesce(a.race_var, b.race_var) as race_var, coalesce(a.metric, b.metric) as metric,
             mean, published_mean, e, n_weeks
      from ests a full join pubs b on a.geography = b.geography and a.week_num = b.week_num and a.race_var = b.race_var
                                  and a.metric = b.metric)
select geography, week_num, race_var, metric, round(mean, 9) as mean, round(published_mean, 9) as published_mean,
       case when n_weeks is null then 'estimate_only' when e is null then 'published_only'
            when n_weeks < 2 then 'incomplete_interval' else 'both' end as status,
       case when n_weeks >= 2 and e is not null and mean is not null and published_mean is not null
            then round(mean, 4) between round(published_mean, 4) - {K.QC_TOLERANCE} and round(published_mean, 4) + {K.QC_TOLERANCE} end as ok
from j"""


def check_published(spark, sf_dir):
    """Food, rent not paid, income loss (2 metrics), stimulus and housing-confidence
    estimates vs the pooled published ratios (4 digits, +-0.002); every cell of either side."""
    from repweave.operators.published import cell_tables, check_against_published, dispatch, published_means_of
    est, parts = _estimates(spark, sf_dir), _published_parts()
    measures = dispatch(cell_tables(survey_rows(spark, sf_dir), {p[0].name: p[0] for p in parts}.values()))
    pubs = published_means_of(measures, crosswalk(spark, est.n_weeks), parts)
    ft = FT.feature_table(est, sort=False).where(F.col("metric").isin([p[1] for p in parts]))
    return check_against_published(ft, pubs)


register("check_published", _check_published_sql())(check_published)


# ------------------------------------------------------------ incremental/sinks --

@register("incremental_weeks", _sql(f"""
, r as (select week, state, cbsa_title, race, inc_loss as x, rep, ({O.rep_weight_sql()}) * 0.5 as w
        from est cross join range(0, {K.N_REPLICATES + 1}) t(rep)),
c as (select week, 'state' as geo_type, state as geography, race, rep, count(x) as n,
             sum(case when x is not null then w end) as sw, sum(w * x) as swx from r group by all
      union all
      select week, 'msa', cbsa_title, race, rep, count(x), sum(case when x is not null then w end), sum(w * x)
      from r group by week, cbsa_title, race, rep)
select week, geo_type, cast(rep as int) as rep, count(*) as cube_rows, cast(sum(n) as bigint) as n,
       round(coalesce(sum(sw), 0), 9) as sw, round(coalesce(sum(swx), 0), 9) as swx
from c group by week, geo_type, rep"""))
def incremental_weeks(spark, sf_dir):
    """A delivery with weeks that it has no more when it is delivered again, the latest week in two parts, one
    of them twice, and the last weeks by files, read by two checkpoints. Each row counts once."""
    import uuid
    from repweave.session import checkpoint_dir
    from repweave.streaming.incremental import deliver, refresh_stream, stored_cube
    base = f"{checkpoint_dir(spark).rstrip('/')}/repweave-incremental-{uuid.uuid4().hex}"
    store = f"{base}/store"
    ei = est_input(spark, sf_dir)
    n = current_week(T.raw_microdata(spark, sf_dir).select("week"))
    late = (F.col("week") == n) & (F.col("rrace") > 2)
    early = F.col("week") < n - 1
    deliver(ei.where(~late), store, "first")
    deliver(ei.where(early), store, "first")
    for _ in range(2):
        deliver(ei.where(late), store, "rest")
    ei.where(~early & ~late).coalesce(2).write.parquet(f"{base}/drops")
    for checkpoint in ("one", "two"):
        refresh_stream(spark, f"{base}/drops", ei.schema, store, f"{base}/{checkpoint}", lambda df: df).awaitTermination()
    return (stored_cube(spark, store).groupBy("week", "geo_type", "rep")
            .agg(F.count(F.lit(1)).alias("cube_rows"), F.sum("n__inc_loss").alias("n"),
                 F.sum("sw__inc_loss").alias("sw"), F.sum("swx__inc_loss").alias("swx")))


REFRESHED = ["inc_loss", "food_insufficient"]


@register("refresh_estimates", _feature_sql(
    "select " + O.rounded(FT.FEATURE_COLS, FEATURE_DOUBLES) + " from ft", REFRESHED))
def refresh_estimates_q(spark, sf_dir):
    """A feature table of two metrics, estimated from the store without the latest week and a part of
    the week before, then brought up to date: only the intervals of those weeks are estimated again."""
    import uuid
    from repweave.session import checkpoint_dir
    from repweave.streaming.incremental import deliver, refresh_estimates
    base = f"{checkpoint_dir(spark).rstrip('/')}/repweave-refresh-{uuid.uuid4().hex}"
    ei = est_input(spark, sf_dir)
    n = current_week(T.raw_microdata(spark, sf_dir).select("week"))
    late = (F.col("week") == n) | (F.col("week") == n - 1) & (F.col("rrace") > 2)
    deliver(ei.where(~late), f"{base}/store", "first", metrics=REFRESHED)
    refresh_estimates(spark, f"{base}/store", f"{base}/table")
    deliver(ei.where(late), f"{base}/store", "rest", metrics=REFRESHED)
    refresh_estimates(spark, f"{base}/store", f"{base}/table")
    return spark.read.parquet(f"{base}/table").select(*FT.FEATURE_COLS)


_ANY = " union all ".join(f"select week, '{m}' as metric from est where {m} is not null" for m in K.METRICS)


@register("publish_bundle", _sql(f"""
, mx as (select max(week) as nw from est),
g as (select (select count(distinct state) from est) + (select count(distinct cbsa_title) from est) as n),
u as (select count(*) as n from (select distinct metric, week - d as i from ({_ANY}), mx, range(0, 2) t(d)
                                 where week - d between 1 and nw - 1)),
c as (select g.n * {len(K.METRICS) * len(K.RACE_INDICATORS)} * (nw - 1) as geo,
             {len(K.METRICS) * len(K.RACE_GROUPS)} * (nw - 1) as nat, u.n as us from g, mx, u),
l as (select 'microdata' as name, (select count(*) from est) as rows
      union all select 'estimates_geo', geo from c union all select 'estimates_national', nat from c
      union all select 'estimates_us_total', us from c
      union all select 'feature_table', geo + nat + us from c union all select 'feature_csv', geo + nat + us from c
      union all select 'metro_names', {len(K.METRO_AREAS)} union all select 'feature_dictionary', 11
      union all select 'appended_dictionary', 29)
select name, cast(rows as bigint) as rows from l"""))
def publish_bundle(spark, sf_dir):
    """Microdata, the three estimate intermediates, the feature table (Parquet
    and CSV), metro names and both dictionaries under one base path; rows as read back."""
    import uuid
    from repweave.session import checkpoint_dir
    from repweave.sources import publish as W
    base = f"{checkpoint_dir(spark).rstrip('/')}/repweave-publish-{uuid.uuid4().hex}"
    rows = est_input(spark, sf_dir)
    W.write_microdata(rows, f"{base}/microdata")
    # the estimates start from the written microdata, one folder per week
    est = FT.estimate(W.read_parquet(spark, f"{base}/microdata"))
    table = FT.feature_table(est)
    listed = W.publish({"estimates_geo": est.geo, "estimates_national": est.national, "estimates_us_total": est.us_total,
                        "feature_table": table, "feature_csv": table, "metro_names": T.metro_table(spark),
                        "feature_dictionary": W.feature_dictionary(spark),
                        "appended_dictionary": W.appended_dictionary(spark)},
                       base, {"feature_csv": W.write_csv})
    micro = W.read_parquet(spark, f"{base}/microdata").agg(F.count(F.lit(1)).alias("rows"))
    return listed.unionByName(micro.select(F.lit("microdata").alias("name"), "rows"))


# -------------------------------------------------------------------- files --

@register("weekly_files", "with " + O.prepared_ctes() + f""",
reps as (select week, sum({O.rep_weight_sql()}) as repw_total from est cross join range(1, {K.N_REPLICATES + 1}) t(rep) group by week)
select week, count(*) as n, count(eip) as n_eip, round(sum(pweight), 9) as pweight_total, count(est_msa) as n_msa,
       round(sum(pweight * food_insufficient), 9) as food, round(sum(pweight * stimulus_expenses), 9) as stimulus,
       count(spend_ui) as n_spend_ui, any_value(round(repw_total, 9)) as repw_total
from est join reps using (week) group by week""")
def weekly_files(spark, sf_dir):
    """Microdata and replicate weights as weekly CSV files with
    unclean headers; the early weeks lack columns in mid-row. Read back by header name, recoded, joined."""
    import uuid
    from repweave.session import checkpoint_dir
    from repweave.sources.files import coerce_numeric, read_weekly_csv
    raw = T.raw_microdata(spark, sf_dir)
    base = f"{checkpoint_dir(spark).rstrip('/')}/repweave-weekly-{uuid.uuid4().hex}"
    names = raw.columns
    early = raw.where(F.col("week") < K.DRIFT_FIRST_WEEK).drop(*K.DRIFT_COLUMNS)
    early = early.toDF(*[c if c == "week" else c.upper().replace("_", " ") for c in early.columns])
    late = raw.where(F.col("week") >= K.DRIFT_FIRST_WEEK).select(
        "week", *[F.col(c).alias("Est.MSA" if c == "est_msa" else c) for c in reversed(names) if c != "week"])
    for df in (early, late):
        df.write.mode("append").partitionBy("week").option("header", True).csv(f"{base}/micro")
    T.raw_repweights(spark, sf_dir).write.partitionBy("week").option("header", True).csv(f"{base}/repw")
    df = read_weekly_csv(spark, f"{base}/micro", [c for c in names if c != "week"])
    df = coerce_numeric(df, [c for c in names if c not in ("week", "scram")])
    weights = [f"pweight{r}" for r in range(1, K.N_REPLICATES + 1)]
    repw = coerce_numeric(read_weekly_csv(spark, f"{base}/repw", ["scram", *weights]), weights)
    out = P.enrich(P.recode_microdata(df), T.state_table(spark, sf_dir), T.metro_table(spark), repw)
    tot = F.aggregate("repw", F.lit(0.0), lambda a, v: a + v)
    return out.groupBy("week").agg(
        F.count(F.lit(1)).alias("n"), F.count("eip").alias("n_eip"), F.sum("pweight").alias("pweight_total"),
        F.count("est_msa").alias("n_msa"), F.sum(F.col("pweight") * F.col("food_insufficient")).alias("food"),
        F.sum(F.col("pweight") * F.col("stimulus_expenses")).alias("stimulus"),
        F.count("spend_ui").alias("n_spend_ui"), F.sum(tot).alias("repw_total"))


_RACE_FAMILIES = ["state_race", "msa_race", "us_race"]
_CELL = "interval_start, geography, metric, race_indicator"


def _race_cells_sql(per_family: str, final: str) -> str:
    """Race cells of states, metros and the nation with what ``per_family`` adds per cell."""
    parts = []
    for f in _RACE_FAMILIES:
        parts.append(per_family.format(f=f))
    union = " union all ".join(f"select o.*, h.* exclude ({_CELL}) from {f}_out o left join {f}_x h using ({_CELL})"
                               for f in _RACE_FAMILIES)
    return ("with " + O.families_sql(_RACE_FAMILIES, cube=True) + "," + ",".join(parts)
            + f", cells as ({union}) " + final)


_HAND_SQL = _race_cells_sql(f"""
{{f}}_h as (select {_CELL}, rep, swx0 / nullif(sw0, 0) - swx1 / nullif(sw1, 0) as d,
                   (swx0 + swx1) / nullif(sw0 + sw1, 0) - swx1 / nullif(sw1, 0) as t from {{f}}_sides),
{{f}}_z as (select {_CELL}, d as d0, t as t0 from {{f}}_h where rep = 0),
{{f}}_x as (select {_CELL}, any_value(d0) as hand_diff_mean, sqrt(4.0 / 80 * sum(power(d - d0, 2)) filter (rep > 0)) as hand_diff_se,
                   any_value(t0) as hand_total_mean, sqrt(4.0 / 80 * sum(power(t - t0, 2)) filter (rep > 0)) as hand_total_se
            from {{f}}_h join {{f}}_z using ({_CELL}) group by {_CELL})""", """
select geo_type, geography, week_num, race_indicator, metric, round(hand_diff_mean, 9) as hand_diff_mean,
       round(hand_diff_se, 9) as hand_diff_se, round(hand_total_mean, 9) as hand_total_mean,
       round(hand_total_se, 9) as hand_total_se, round(diff_mean, 9) as diff_mean, round(diff_se, 9) as diff_se,
       case when hand_diff_mean is not null then true end as ok from cells""")


@register("check_manual", _HAND_SQL)
def check_manual(spark, sf_dir):
    """By-hand differences (4/80 formula on filtered means, and against the
    geography's total) beside the contrasts, every race cell of states, metros and the nation."""
    from repweave.operators.by_hand import KEYS, by_hand
    ei = est_input(spark, sf_dir)
    est = FT.estimate(ei)
    hand = by_hand(ei, n_weeks=est.n_weeks)
    cells = est.geo.where("race_indicator <> 'total'").unionByName(est.national)
    j = cells.select(*KEYS, "week_num", "diff_mean", "diff_se").join(hand.drop("week_num"), KEYS, "left")
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= 1.5e-8
    ok = F.when(F.col("hand_diff_mean").isNotNull(),
                near("hand_diff_mean", "diff_mean") & near("hand_diff_se", "diff_se"))
    return j.select("geo_type", "geography", "week_num", "race_indicator", "metric", "hand_diff_mean", "hand_diff_se",
                    "hand_total_mean", "hand_total_se", "diff_mean", "diff_se", ok.alias("ok"))


_GLM_CELLS_SQL = _race_cells_sql(f"""
{{f}}_b as (select {_CELL}, rep, (s * swx1 - sw1 * (swx1 + swx0)) / nullif(s * sw1 - sw1 * sw1, 0) as b
            from (select *, sw1 + sw0 as s from {{f}}_sides)),
{{f}}_z as (select {_CELL}, b as b0 from {{f}}_b where rep = 0),
{{f}}_x as (select {_CELL}, any_value(b0) as slope,
                   2 * sqrt(coalesce(sum(power(b - b0, 2)) filter (rep > 0), 0) / {K.N_REPLICATES}) as slope_se
            from {{f}}_b join {{f}}_z using ({_CELL}) group by {_CELL})""", """
select geo_type, geography, week_num, race_indicator, metric, round(slope, 9) as slope,
       case when slope is not null then round(slope_se, 9) end as slope_se, round(diff_mean, 9) as diff_mean,
       round(diff_se, 9) as diff_se, case when slope is not null then true end as ok from cells""")
register("check_glm", _GLM_CELLS_SQL)(check_glm)


@register("hh_size_by_state_race", _sql("""
select week, state, hisp_rrace,
       case when count(thhld_numper) = count(*) then avg(thhld_numper) end as mean, count(*) as n
from (select distinct scram, week, state, hisp_rrace, thhld_numper from rec) d
group by week, state, hisp_rrace"""))
def hh_size_by_state_race(spark, sf_dir):
    """A17 cross + O2: mean household size by week, state and race label, in
    ascending (week, mean) order."""
    from repweave.operators.reshape import group_mean
    d = survey_rows(spark, sf_dir).dropDuplicates(["scram", "week"])
    return group_mean(d, ["week", "state", "hisp_rrace"], "thhld_numper").orderBy("week", "mean")


# ------------------------------------------------ covariance, guards, samples --

_COV_SQL = "with " + O.prepared_ctes() + "," + O.cube_ctes(K.METRICS) + """,
th as (select interval_start, race, metric, rep, sum(swx) / nullif(sum(sw), 0) as t from lng_state
       group by interval_start, race, metric, rep),
off as (select a.interval_start, a.race, a.metric, a.rep, a.t - b.t as d from th a join th b
        on a.interval_start = b.interval_start and a.metric = b.metric and a.race is not distinct from b.race
       and b.rep = 0 where a.rep > 0),
cov as (select x.interval_start, x.metric, x.race as group_i, y.race as group_j, coalesce(sum(x.d * y.d), 0) / 80 as cov
        from off x join off y using (interval_start, metric, rep) group by all)"""


def _race_matrix(spark, sf_dir):
    from repweave.operators.covariance import group_matrix, group_replicates
    from repweave.operators.cube import sufficient_stats, to_intervals
    wc = FT.materialize(sufficient_stats(est_input(spark, sf_dir), ROLLING, K.METRICS, ["week", "race"]), "race-cube")
    cube = to_intervals(wc, current_week(wc))
    return group_matrix(group_replicates(cube, ROLLING, ["week_num"], "race"), ROLLING, ["week_num"])


@register("race_covariance", _COV_SQL + """
select 'wk' || interval_start || '_' || (interval_start + 1) as week_num, metric, group_i, group_j, round(cov, 9) as cov from cov""")
def race_covariance(spark, sf_dir):
    """A4: covariances of the race groups' national estimates, per interval and metric."""
    from repweave.operators.covariance import covariances
    return covariances(_race_matrix(spark, sf_dir), ["week_num"])


#: One group against the average of two others.
_CONTRAST = {"black": 1.0, "white": -0.5, "hispanic": -0.5}
_COEF = "case {c} " + " ".join(f"when '{g}' then {a}" for g, a in _CONTRAST.items()) + " else 0 end"


@register("contrast_any", _COV_SQL + f""",
se as (select interval_start, metric, 2 * sqrt(greatest(sum(cov * {_COEF.format(c='group_i')} * {_COEF.format(c='group_j')}), 0)) as se
       from cov group by interval_start, metric),
mean as (select interval_start, metric, sum(t * {_COEF.format(c='race')}) as m, count(*) filter (race in {tuple(_CONTRAST)}) as k
         from th where rep = 0 group by interval_start, metric)
select 'wk' || interval_start || '_' || (interval_start + 1) as week_num, metric,
       case when k = {len(_CONTRAST)} then round(m, 9) end as estimate, case when k = {len(_CONTRAST)} then round(se, 9) end as se
from mean join se using (interval_start, metric)""")
def contrast_any(spark, sf_dir):
    """A contrast of three groups, its error from the covariance matrix."""
    from repweave.operators.covariance import contrast
    return contrast(_race_matrix(spark, sf_dir), ROLLING, ["week_num"], _CONTRAST)


@register("join_guards_observed", _sql("""
, n as (select count(*) as n from rec)
select name, n as rows_in, n as rows_out, true as ok from n, (values ('states'), ('metros'), ('weights')) t(name)"""))
def join_guards_observed(spark, sf_dir):
    """Prepared microdata is written; its job counts the rows around each of its joins as it runs."""
    from repweave.operators.joins import JoinGuards
    guards = JoinGuards()
    FT.materialize(P.prepare(spark, sf_dir, guards), "prepared")
    guards.check()
    return spark.createDataFrame(guards.report(), "name string, rows_in long, rows_out long, ok boolean")


@register("sample_with_replacement", _sql("""
, placed as (select scram, week, row_number() over (order by md5('42|' || scram || '|' || week), scram, week) - 1 as place from rec),
drawn as (select cast('0x' || substr(md5('42|draw|' || d), 1, 12) as bigint) % (select count(*) from rec) as place
          from range(1, 5001) t(d))
select scram, week, count(*) as multiplicity from drawn join placed using (place) group by scram, week"""))
def sample_with_replacement_q(spark, sf_dir):
    """O3: 5,000 draws with replacement from all respondents."""
    from repweave.operators.reshape import sample_with_replacement
    rows = recoded(spark, sf_dir).select("scram", "week")
    return sample_with_replacement(rows, 5000, 42, ["scram", "week"], bucket_rows=2000)


@register("frame_diff_by_digest", _sql("""
select scram, week, 'both' as side from est where o_orderkey % 997 = 0 and pweight is not null
union all select scram, week, 'left_only' from est where o_orderkey % 991 = 0 and o_orderkey % 997 <> 0"""))
def frame_diff_by_digest_q(spark, sf_dir):
    """Two outputs with planted changes and missing rows; only the buckets that differ are joined."""
    from repweave.operators.reshape import frame_diff_by_digest
    a = est_input(spark, sf_dir).select("o_orderkey", "scram", "week", "pweight", "race", "state", *K.METRICS)
    changed = F.when(F.col("o_orderkey") % 997 == 0, F.col("pweight") + 1).otherwise(F.col("pweight"))
    b = a.withColumn("pweight", changed).where((F.col("o_orderkey") % 991 != 0) | (F.col("o_orderkey") % 997 == 0))
    return frame_diff_by_digest(a.drop("o_orderkey"), b.drop("o_orderkey"), ["scram", "week"])


# ------------------------------------------------------- cell files, bundles --

def cell_files(spark, sf_dir):
    """A published table as headerless files, one per week and sheet, with six title lines; read back by line
    number and width, then normalised."""
    import uuid
    from repweave.operators.published import SPECS, cell_table, normalise, positional
    from repweave.session import checkpoint_dir
    from repweave.sources.cells import line_of, read_cells, write_cell_files
    spec = SPECS["health2b"]
    path = f"{checkpoint_dir(spark).rstrip('/')}/repweave-cells-{uuid.uuid4().hex}"
    made = positional(cell_table(survey_rows(spark, sf_dir), spec), spec)
    line = F.concat_ws(",", line_of([F.col("variable")]), F.array_join(
        F.transform("cells", lambda c: F.coalesce(c.cast("string"), F.lit(""))), ","))
    titles = ["Table of households", "Source: survey", "", "Select characteristics,Total", "(in persons)", '"a, b",,']
    write_cell_files(made, path, ["file", "sheet"], "row_idx", line, titles)
    read = read_cells(spark, path, skip=len(titles)).select(
        F.lit(spec.name).alias("table"), "file", "sheet", F.get("cells", F.lit(0)).alias("variable"), F.col("line").alias("row_idx"),
        F.transform(F.slice("cells", F.lit(2), F.size("cells")), lambda c: c.cast("double")).alias("cells"))
    return normalise(read, spec)


def _register_cell_files():
    from repweave.operators.published import SPECS
    register("cell_files", _normalise_sql(SPECS["health2b"]))(cell_files)


_register_cell_files()


@register("metro_code_file", SQL["enrich_metro"])
def metro_code_file(spark, sf_dir):
    """The metro codes are a headerless file with three title lines and a note below, read by line number and
    width, and joined to the respondents."""
    import uuid
    from repweave.operators.joins import left_lookup
    from repweave.session import checkpoint_dir
    from repweave.sources.cells import line_of, read_cells, write_cell_files
    path = f"{checkpoint_dir(spark).rstrip('/')}/repweave-metro-{uuid.uuid4().hex}"
    made = T.metro_table(spark).withColumns({"list": F.lit("metro"), "at": F.col("cbsa_code").cast("int")})
    note = spark.createDataFrame([("Note: codes of 2020", None, None, "metro", 10_000)], made.schema)
    line = F.when(F.col("csa_title").isNull(), F.col("cbsa_code")).otherwise(line_of([F.col("cbsa_code"), F.col("csa_title"), F.col("cbsa_title")]))
    write_cell_files(made.unionByName(note), path, ["list"], "at", line, ["List of metro areas", "", "Code,Combined area,Title"])
    cells = read_cells(spark, path, skip=3).where(F.size("cells") == 3)
    metros = cells.select(*[F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(["cbsa_code", "csa_title", "cbsa_title"])])
    rows = P.recode_microdata(T.raw_microdata(spark, sf_dir))
    named = left_lookup(rows, metros, "est_msa", "cbsa_code", max_rows=10_000)
    return named.groupBy("est_msa", "cbsa_title", "csa_title").agg(F.count(F.lit(1)).alias("n"))


_CHECK = "cast(coalesce(sum(cast('0x' || substr(md5(concat_ws('|', {cells})), 1, 8) as bigint)), 0) as bigint) as checksum"


def _checksum_sql(cols: list[str], doubles: list[str]) -> str:
    cells = ", ".join(f"coalesce(cast({f'cast(round({c} * 1e6) as bigint)' if c in doubles else c} as varchar), '~')" for c in cols)
    return _CHECK.format(cells=cells)


_MICRO = ["scram", "week", "state", "cbsa_title", "race", "pweight", *REFRESHED]


@register("publish_dated", _feature_sql(f"""
, l as (select 'feature_table' as name, count(*) as rows, {_checksum_sql(FT.FEATURE_COLS, FEATURE_DOUBLES)} from ft
        union all select 'microdata', count(*), {_checksum_sql(_MICRO, ["pweight", *REFRESHED])} from est)
select d as date, name, cast(rows as bigint) as rows, checksum from l, (values ('2020-10-14'), ('latest')) t(d)
union all select '2020-10-14', 'feature_csv', count(*), {_checksum_sql(FT.FEATURE_COLS, FEATURE_DOUBLES)} from ft
union all select 'latest', 'feature_csv', count(*), {_checksum_sql(FT.FEATURE_COLS, FEATURE_DOUBLES)} from ft""", REFRESHED))
def publish_dated(spark, sf_dir):
    """Microdata, feature table and its CSV form published under a date and as the latest, after an earlier
    bundle of half the rows; rows and checksums of the values that readers get."""
    import uuid
    from repweave.session import checkpoint_dir
    from repweave.sources import bundle as B
    base = f"{checkpoint_dir(spark).rstrip('/')}/repweave-dated-{uuid.uuid4().hex}"
    ei = est_input(spark, sf_dir)
    micro = ei.select(*_MICRO)
    B.publish_bundle({"microdata": micro.where("week < 6")}, base, "2020-09-30")
    table = FT.feature_table(FT.estimate(ei, metrics=REFRESHED))
    B.publish_bundle({"microdata": micro, "feature_table": table, "feature_csv": table}, base, "2020-10-14", {"feature_csv": "csv"})
    out = None
    for label, date in (("2020-10-14", "2020-10-14"), ("latest", None)):
        for name in ("microdata", "feature_table", "feature_csv"):
            row = B.value_checksum(B.open_table(spark, base, name, date)).select(F.lit(label).alias("date"), F.lit(name).alias("name"), "rows", "checksum")
            out = row if out is None else out.unionByName(row)
    return out

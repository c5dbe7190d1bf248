"""Independent ANSI-SQL (DuckDB) formulations used as the correctness oracle.

not generated from the Spark plans: recodes as CASE, replicate weights as a
join with ``range(0, 81)``, estimators as plain GROUP BY over (cell, side,
replicate). They are meant for sf0.01-sized checks, not for scale.
"""

from __future__ import annotations

from repweave import constants as K

R = K.N_REPLICATES

PROJECTION = """
select o_orderkey,
  concat('V', o_orderkey) as scram,
  cast(((o_orderkey+1)*7919)%1000003%12+1 as int) as week,
  c_nationkey as est_st,
  case when ((o_orderkey+1)*32452843)%1000003%3=0 then cast(((o_orderkey+1)*49979687)%1000003%15 as int) end as est_msa,
  ((o_orderkey+1)*104729)%1000003%4+1 as rrace,
  case when ((o_orderkey+1)*15485863)%1000003%5=0 then 2 else 1 end as rhispanic,
  ((o_orderkey+1)*67867967)%1000003%73+1930 as tbirth_year,
  ((o_orderkey+1)*86028121)%1000003%4+1 as tenure,
  ((o_orderkey+1)*256203161)%1000003%9+1 as thhld_numper,
  case ((o_orderkey+1)*122949823)%1000003%8 when 0 then -88 when 1 then -99 else ((o_orderkey+1)*122949823)%1000003%8%5+1 end as mortconf,
  case ((o_orderkey+1)*198491317)%1000003%7 when 0 then -88 when 1 then -99 else ((o_orderkey+1)*198491317)%1000003%7%3+1 end as mortlmth,
  case ((o_orderkey+1)*141650939)%1000003%6 when 0 then -88 when 1 then -99 else ((o_orderkey+1)*141650939)%1000003%6%2+1 end as wrkloss,
  case ((o_orderkey+1)*179424673)%1000003%6 when 0 then -88 when 1 then -99 else ((o_orderkey+1)*179424673)%1000003%6%2+1 end as expctloss,
  case ((o_orderkey+1)*275604541)%1000003%9 when 0 then -88 when 1 then -99 else ((o_orderkey+1)*275604541)%1000003%9%4+1 end as curfoodsuf,
  case ((o_orderkey+1)*295075147)%1000003%9 when 0 then -88 when 1 then -99 else ((o_orderkey+1)*295075147)%1000003%9%4+1 end as anxious,
  case ((o_orderkey+1)*314606869)%1000003%9 when 0 then -88 when 1 then -99 else ((o_orderkey+1)*314606869)%1000003%9%4+1 end as worry,
  case ((o_orderkey+1)*334214459)%1000003%9 when 0 then -88 when 1 then -99 else ((o_orderkey+1)*334214459)%1000003%9%4+1 end as interest,
  case ((o_orderkey+1)*353868013)%1000003%9 when 0 then -88 when 1 then -99 else ((o_orderkey+1)*353868013)%1000003%9%4+1 end as down,
  case ((o_orderkey+1)*236887691)%1000003%10 when 0 then -88 when 1 then -99 else case ((o_orderkey+1)*15493787)%1000003%5 when 0 then 1 when 1 then -99 else 2 end end as hlthins1,
  case ((o_orderkey+1)*236887691)%1000003%10 when 0 then -88 when 1 then -99 else case ((o_orderkey+1)*15501707)%1000003%5 when 0 then 1 when 1 then -99 else 2 end end as hlthins2,
  case ((o_orderkey+1)*236887691)%1000003%10 when 0 then -88 when 1 then -99 else case ((o_orderkey+1)*15509627)%1000003%5 when 0 then 1 when 1 then -99 else 2 end end as hlthins3,
  case ((o_orderkey+1)*236887691)%1000003%10 when 0 then -88 when 1 then -99 else case ((o_orderkey+1)*15517547)%1000003%5 when 0 then 1 when 1 then -99 else 2 end end as hlthins4,
  case ((o_orderkey+1)*236887691)%1000003%10 when 0 then -88 when 1 then -99 else case ((o_orderkey+1)*15525467)%1000003%5 when 0 then 1 when 1 then -99 else 2 end end as hlthins5,
  case ((o_orderkey+1)*236887691)%1000003%10 when 0 then -88 when 1 then -99 else case ((o_orderkey+1)*15533387)%1000003%5 when 0 then 1 when 1 then -99 else 2 end end as hlthins6,
  case ((o_orderkey+1)*236887691)%1000003%10 when 0 then -88 when 1 then -99 else case ((o_orderkey+1)*15541307)%1000003%5 when 0 then 1 when 1 then -99 else 2 end end as hlthins7,
  case ((o_orderkey+1)*236887691)%1000003%10 when 0 then -88 when 1 then -99 else case ((o_orderkey+1)*15549227)%1000003%5 when 0 then 1 when 1 then -99 else 2 end end as hlthins8,
  case when ((o_orderkey+1)*373587883)%1000003%3=0 then -88 else case when ((o_orderkey+1)*32460787)%1000003%4=0 then 1 else -99 end end as teach1,
  case when ((o_orderkey+1)*373587883)%1000003%3=0 then -88 else case when ((o_orderkey+1)*32468707)%1000003%4=0 then 1 else -99 end end as teach2,
  case when ((o_orderkey+1)*373587883)%1000003%3=0 then -88 else case when ((o_orderkey+1)*32476627)%1000003%4=0 then 1 else -99 end end as teach3,
  case when ((o_orderkey+1)*373587883)%1000003%3=0 then -88 else case when ((o_orderkey+1)*32484547)%1000003%4=0 then 1 else -99 end end as teach4,
  case when ((o_orderkey+1)*373587883)%1000003%3=0 then -88 else case when ((o_orderkey+1)*32492467)%1000003%4=0 then 1 else -99 end end as teach5,
  case when ((o_orderkey+1)*7919)%1000003%12+1>=7 then case ((o_orderkey+1)*393342739)%1000003%7 when 0 then -88 when 1 then -99 else ((o_orderkey+1)*393342739)%1000003%7%4+1 end end as eip,
  case when ((o_orderkey+1)*7919)%1000003%12+1>=7 then case ((o_orderkey+1)*413158511)%1000003%8 when 0 then -88 when 1 then -99 else case when ((o_orderkey+1)*49987613)%1000003%3=0 then 1 else -99 end end end as spndsrc1,
  case when ((o_orderkey+1)*7919)%1000003%12+1>=7 then case ((o_orderkey+1)*413158511)%1000003%8 when 0 then -88 when 1 then -99 else case when ((o_orderkey+1)*49995533)%1000003%3=0 then 1 else -99 end end end as spndsrc2,
  case when ((o_orderkey+1)*7919)%1000003%12+1>=7 then case ((o_orderkey+1)*413158511)%1000003%8 when 0 then -88 when 1 then -99 else case when ((o_orderkey+1)*50003453)%1000003%3=0 then 1 else -99 end end end as spndsrc3,
  case when ((o_orderkey+1)*7919)%1000003%12+1>=7 then case ((o_orderkey+1)*413158511)%1000003%8 when 0 then -88 when 1 then -99 else case when ((o_orderkey+1)*50011373)%1000003%3=0 then 1 else -99 end end end as spndsrc4,
  case when ((o_orderkey+1)*7919)%1000003%12+1>=7 then case ((o_orderkey+1)*413158511)%1000003%8 when 0 then -88 when 1 then -99 else case when ((o_orderkey+1)*50019293)%1000003%3=0 then 1 else -99 end end end as spndsrc5,
  case when ((o_orderkey+1)*7919)%1000003%12+1>=7 then case ((o_orderkey+1)*413158511)%1000003%8 when 0 then -88 when 1 then -99 else case when ((o_orderkey+1)*50027213)%1000003%3=0 then 1 else -99 end end end as spndsrc6,
  case when ((o_orderkey+1)*7919)%1000003%12+1>=7 then case ((o_orderkey+1)*413158511)%1000003%8 when 0 then -88 when 1 then -99 else case when ((o_orderkey+1)*50035133)%1000003%3=0 then 1 else -99 end end end as spndsrc7,
  case ((o_orderkey+1)*433494437)%1000003%9 when 0 then -88 when 1 then -99 else ((o_orderkey+1)*433494437)%1000003%9%5+1 end as device,
  case ((o_orderkey+1)*472882027)%1000003%9 when 0 then -88 when 1 then -99 else ((o_orderkey+1)*472882027)%1000003%9%5+1 end as intrnt,
  case ((o_orderkey+1)*492876847)%1000003%7 when 0 then -88 when 1 then -99 else ((o_orderkey+1)*492876847)%1000003%7%2+1 end as delay,
  case ((o_orderkey+1)*512927357)%1000003%7 when 0 then -88 when 1 then -99 else ((o_orderkey+1)*512927357)%1000003%7%2+1 end as notget,
  case ((o_orderkey+1)*533000389)%1000003%7 when 0 then -88 when 1 then -99 else ((o_orderkey+1)*533000389)%1000003%7%2+1 end as anywork,
  case ((o_orderkey+1)*553105253)%1000003%9 when 0 then -88 when 1 then -99 else ((o_orderkey+1)*553105253)%1000003%9%5+1 end as kindwork,
  cast(((o_orderkey+1)*160481183)%1000003%900+100 as double) as pweight
from orders join customer on o_custkey = c_custkey
"""


def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def metro_values() -> str:
    rows = ", ".join(f"('{i}', {_sq(short)}, {_sq(title)})"
                     for i, (title, short, _) in enumerate(K.METRO_AREAS))
    return f"(values {rows}) as mt(cbsa_code, csa_title, cbsa_title)"


def _h(cols: list[str], op: str, val: int) -> str:
    return f" {op} ".join(f"{c} = {val}" for c in cols)


H16 = [f"hlthins{i}" for i in range(1, 7)]
H18 = [f"hlthins{i}" for i in range(1, 9)]
TEACH = [f"teach{i}" for i in range(1, 6)]
SPND = [f"spndsrc{i}" for i in range(1, 8)]


def _spend(i: int) -> str:
    answered = " or ".join(f"{c} >= 0" for c in SPND)
    return f"case when spndsrc{i} = 1 then 1 when {answered} then 0 end::double"


RECODE_LEVEL1 = f"""
  case when rhispanic = 2 then {_sq(K.RACE_LABEL_HISPANIC)}
       else case rrace when 1 then {_sq(K.RACE_LABEL_WHITE)} when 2 then {_sq(K.RACE_LABEL_BLACK)}
                       when 3 then {_sq(K.RACE_LABEL_ASIAN)} when 4 then {_sq(K.RACE_LABEL_OTHER)} end
  end as hisp_rrace,
  case when {_h(H16, 'or', 1)} then 0 when {_h(H16, 'and', 2)} then 1 when hlthins7 = 1 then 1 end::double as uninsured,
  case when hlthins3 = 1 or hlthins4 = 1 or hlthins6 = 1 then 1
       when {_h(H18, 'and', -99)} then null when {_h(H18, 'and', -88)} then null else 0 end::double as insured_public,
  case wrkloss when 1 then 1 when 2 then 0 end::double as inc_loss,
  case expctloss when 1 then 1 when 2 then 0 end::double as expect_inc_loss,
  case when mortconf in (1, 2, 5) then 1 when mortconf in (3, 4) then 0 end::double as payment_not_conf,
  case when mortconf in (1, 2, 5) and tenure = 3 then 1 when mortconf in (3, 4) and tenure = 3 then 0 end::double as rent_not_conf,
  case when mortconf in (1, 2, 5) and tenure = 2 then 1 when mortconf in (3, 4) and tenure = 2 then 0 end::double as mortgage_not_conf,
  case when mortlmth in (2, 3) and tenure = 3 then 1 when mortlmth = 1 and tenure = 3 then 0 end::double as rent_not_paid,
  case when mortlmth in (2, 3) and tenure = 2 then 1 when mortlmth = 1 and tenure = 2 then 0 end::double as mortgage_not_paid,
  case when curfoodsuf in (3, 4) then 1 when curfoodsuf in (1, 2) then 0 end::double as food_insufficient,
  case when teach1 = 1 then 1 when {" or ".join(f"{c} >= 0" for c in TEACH)} then 0 end::double as classes_cancelled,
  case when eip = 1 then 1 when eip in (2, 3) then 0 end::double as stimulus_expenses,
  {_spend(2)} as spend_credit,
  {_spend(3)} as spend_savings,
  {_spend(5)} as spend_ui,
  {_spend(6)} as spend_stimulus,
  case when anxious in (1, 2, 3, 4) then anxious - 1 end::double as anxious_score,
  case when worry in (1, 2, 3, 4) then worry - 1 end::double as worry_score,
  case when interest in (1, 2, 3, 4) then interest - 1 end::double as interest_score,
  case when down in (1, 2, 3, 4) then down - 1 end::double as down_score
"""

RECODE_LEVEL2 = """
  case when coalesce(anxious_score, 0) + coalesce(worry_score, 0) >= 3 then 1
       when anxious_score is null and worry_score is null then null else 0 end::double as anxiety_signs,
  case when coalesce(interest_score, 0) + coalesce(down_score, 0) >= 3 then 1
       when interest_score is null and down_score is null then null else 0 end::double as depression_signs
"""

RECODE_LEVEL3 = """
  case when anxiety_signs = 1 or depression_signs = 1 then 1
       when anxiety_signs is null and depression_signs is null then null else 0 end::double as depression_anxiety_signs
"""


def race_case(col: str = "hisp_rrace") -> str:
    parts = " ".join(f"when {col} like '%{pat}%' then '{name}'"
                     for name, pat in K.RACE_PATTERNS.items())
    return f"case {parts} end"


def prepared_ctes() -> str:
    """CTEs: micro (projection), rec (recodes + names), est (age rule + race)."""
    return f"""
micro as ({PROJECTION}),
rec1 as (select *, {RECODE_LEVEL1} from micro),
rec2 as (select *, {RECODE_LEVEL2} from rec1),
rec3 as (select *, {RECODE_LEVEL3} from rec2),
rec as (
  select r.*, cast(cast(r.est_msa as int) as varchar) as est_msa_s, 'wk' || r.week as week_num,
         n.n_name as state, n.n_name as state_name, mt.csa_title, mt.cbsa_title
  from rec3 r
  left join nation n on r.est_st = n.n_nationkey
  left join {metro_values()} on cast(cast(r.est_msa as int) as varchar) = mt.cbsa_code
),
est as (
  select * replace (
           case when tbirth_year < 1956 then null else insured_public end as insured_public,
           case when tbirth_year < 1956 then null else uninsured end as uninsured),
         {race_case()} as race
  from rec
)"""


def rep_weight_sql(rep: str = "rep", key: str = "o_orderkey", w: str = "pweight") -> str:
    """Weight of replicate ``rep`` (0 = full sample)."""
    return (f"case when {rep} = 0 then {w} else {w} * (0.5 + (({key}+1)*(2*{rep}+1)*7919) "
            f"% 1000003 % 2) end")


def metric_list(metrics: list[str]) -> str:
    return ", ".join(metrics)


def long_ctes(metrics: list[str], factor: float = 0.5) -> str:
    """CTEs: iv (rows fanned out to intervals) and lng (interval x metric x rep)."""
    return f"""
mxw as (select max(week) as nw from est),
iv as (
  select est.*, week - 1 as interval_start from est, mxw where week - 1 >= 1 and week - 1 <= nw - 1
  union all
  select est.*, week as interval_start from est, mxw where week >= 1 and week <= nw - 1
),
unp as (
  select o_orderkey, pweight, interval_start, state, cbsa_title, race, metric, x
  from (unpivot (select o_orderkey, pweight, interval_start, state, cbsa_title, race, {metric_list(metrics)} from iv)
        on {metric_list(metrics)} into name metric value x)
),
lng as (
  select u.*, t.rep, ({rep_weight_sql('t.rep', 'u.o_orderkey', 'u.pweight')}) * {factor} as w
  from unp u cross join range(0, {R + 1}) t(rep)
)"""


def cube_ctes(metrics: list[str], factor: float = 0.5) -> str:
    """CTEs lng_state and lng_msa: (interval_start, geography, race, metric, rep) with n, sw, swx.

    Weights are summed once per week, geography, race and replicate, with the metrics as
    columns, before anything is stacked or fanned out to intervals."""
    sums = ", ".join(f"count({m}) as n__{m}, sum(case when {m} is not null then w end) as sw__{m}, "
                     f"sum(w * {m}) as swx__{m}" for m in metrics)

    def stacked(src: str) -> str:
        return " union all ".join(
            f"select week, geography, race, rep, '{m}' as metric, n__{m} as n, sw__{m} as sw, swx__{m} as swx "
            f"from {src} where n__{m} > 0" for m in metrics)

    parts = [f"""
mxw as (select max(week) as nw from est),
reps as (select week, state, cbsa_title, race, {metric_list(metrics)}, rep, ({rep_weight_sql()}) * {factor} as w
         from est cross join range(0, {R + 1}) t(rep))"""]
    for name, geo in (("state", "state"), ("msa", "cbsa_title")):
        parts.append(f"""
wide_{name} as materialized (select week, {geo} as geography, race, rep, {sums} from reps group by week, {geo}, race, rep),
lng_{name} as materialized (
  select week - d as interval_start, geography, race, metric, rep, sum(n) as n, sum(sw) as sw, sum(swx) as swx
  from ({stacked(f"wide_{name}")}) s, mxw, range(0, 2) t(d) where week - d between 1 and nw - 1
  group by week - d, geography, race, metric, rep)""")
    return ",".join(parts)


def two_sided_ctes(p: str, sides: str) -> str:
    """CTEs ``{p}_th``, ``{p}_c0``, ``{p}_var``, ``{p}_est`` from a sides CTE with
    (cell keys: interval_start, geography, metric, race_indicator), rep,
    sw1, swx1, n1, sw0, swx0, n0."""
    ck = "interval_start, geography, metric, race_indicator"
    return f"""
{p}_th as (
  select {ck}, rep, n1, n0, swx1 / nullif(sw1, 0) as t1, swx0 / nullif(sw0, 0) as t0,
         swx0 / nullif(sw0, 0) - swx1 / nullif(sw1, 0) as d
  from {sides}
),
{p}_c0 as (select {ck}, n1, n0, t1 as m1, t0 as m0, d as md from {p}_th where rep = 0),
{p}_var as (
  select {ck},
    coalesce(sum(power(t.t1 - c.m1, 2)), 0) / {R} as v1,
    coalesce(sum(power(t.t0 - c.m0, 2)), 0) / {R} as v0,
    coalesce(sum(power(t.d - c.md, 2)), 0) / {R} as vd
  from {p}_th t join {p}_c0 c using ({ck}) where t.rep > 0 group by {ck}
),
{p}_est as (
  select {ck},
    case when c.n1 = 0 or c.n0 = 0 then null else c.m1 end as mean,
    case when c.n1 = 0 or c.n0 = 0 then 0 else 2 * sqrt(v1) end as se,
    case when c.n1 = 0 or c.n0 = 0 then null else c.m0 end as other_mean,
    case when c.n1 = 0 or c.n0 = 0 then 0 else sqrt(v0) end as other_se,
    case when c.n1 = 0 or c.n0 = 0 then 0 else c.md end as diff_mean,
    case when c.n1 = 0 or c.n0 = 0 then 0 else 2 * sqrt(vd) end as diff_se,
    case when c.n1 = 0 or c.n0 = 0 then 0 else c.n1 end as n1,
    case when c.n1 = 0 or c.n0 = 0 then 0 else c.n0 end as n0
  from {p}_c0 c join {p}_var v using ({ck})
)"""


def _values(col: str, items: list[str]) -> str:
    rows = ", ".join(f"({_sq(x)})" for x in items)
    return f"(select * from (values {rows}) v({col}))"


def family_ctes(p: str, kind: str, geo: str, geo_type: str, metrics: list[str], cube: bool = False) -> str:
    """Grid-filled estimates of one family as CTE ``{p}_out``.

    kind 'race': each race group vs the rest of the same geography.
    kind 'geo':  each geography vs all other rows (incl. NULL-geography).
    ``cube`` reads the sums of ``cube_ctes`` instead of the rows of ``long_ctes``.
    """
    src, at, sums = "lng", geo, "sum(w) as sw, sum(w * x) as swx, count(*) as n"
    if cube:
        src = "lng_msa" if geo == "cbsa_title" else "lng_state"
        at = geo if geo.startswith("'") else "geography"
        sums = "sum(sw) as sw, sum(swx) as swx, cast(sum(n) as bigint) as n"
    groups = K.RACE_GROUPS if kind == "race" else ["total"]
    if kind == "race":
        geo_filter = "" if geo.startswith("'") else f"where {at} is not null"
        sides = f"""
{p}_cls as (select interval_start, {at} as geography, race, metric, rep, {sums}
            from {src} {geo_filter} group by all),
{p}_tg as {_values('race_indicator', groups)},
{p}_sides as (
  select c.interval_start, c.geography, c.metric, tg.race_indicator, c.rep,
    sum(case when c.race = tg.race_indicator then c.sw end) as sw1,
    sum(case when c.race = tg.race_indicator then c.swx end) as swx1,
    coalesce(sum(case when c.race = tg.race_indicator then c.n end), 0) as n1,
    sum(case when c.race is distinct from tg.race_indicator then c.sw end) as sw0,
    sum(case when c.race is distinct from tg.race_indicator then c.swx end) as swx0,
    coalesce(sum(case when c.race is distinct from tg.race_indicator then c.n end), 0) as n0
  from {p}_cls c cross join {p}_tg tg group by all
),"""
    else:
        sides = f"""
{p}_g as (select interval_start, {at} as geography, metric, rep, {sums}
          from {src} group by all),
{p}_sides as (
  select a.interval_start, a.geography, a.metric, 'total' as race_indicator, a.rep,
    a.sw as sw1, a.swx as swx1, a.n as n1,
    sum(b.sw) as sw0, sum(b.swx) as swx0, coalesce(sum(b.n), 0) as n0
  from {p}_g a left join {p}_g b
    on a.interval_start = b.interval_start and a.metric = b.metric and a.rep = b.rep
   and b.geography is distinct from a.geography
  where a.geography is not null
  group by a.interval_start, a.geography, a.metric, a.rep, a.sw, a.swx, a.n
),"""
    geos = (f"(select {geo} as geography)" if geo.startswith("'") else
            f"(select distinct {geo} as geography from est where {geo} is not null)")
    return sides + two_sided_ctes(p, f"{p}_sides") + f""",
{p}_grid as (
  select g.geography, cast(i.interval_start as int) as interval_start, m.metric, r.race_indicator
  from {geos} g, mxw, range(1, mxw.nw) i(interval_start),
       {_values('metric', metrics)} m, {_values('race_indicator', groups)} r
),
{p}_out as (
  select gr.metric, gr.race_indicator, 'wk' || gr.interval_start || '_' || (gr.interval_start + 1) as week_num,
    gr.interval_start, gr.geography, '{geo_type}' as geo_type,
    e.mean, coalesce(e.se, 0) as se, e.other_mean, coalesce(e.other_se, 0) as other_se,
    coalesce(e.diff_mean, 0) as diff_mean, coalesce(e.diff_se, 0) as diff_se,
    cast(coalesce(e.n1, 0) as bigint) as n1, cast(coalesce(e.n0, 0) as bigint) as n0
  from {p}_grid gr left join {p}_est e using (interval_start, geography, metric, race_indicator)
)"""


ESTIMATE_OUT = ["metric", "race_indicator", "week_num", "geography", "geo_type", "mean", "se",
                "other_mean", "other_se", "diff_mean", "diff_se", "n1", "n0"]
ESTIMATE_DOUBLES = ["mean", "se", "other_mean", "other_se", "diff_mean", "diff_se"]


def rounded(cols: list[str], doubles: list[str], prefix: str = "") -> str:
    return ", ".join(f"round({prefix}{c}, 9) as {c}" if c in doubles else f"{prefix}{c}"
                     for c in cols)


FAMILIES = {
    "state_race": ("race", "state", "state"),
    "msa_race": ("race", "cbsa_title", "msa"),
    "us_race": ("race", "'US'", "national"),
    "state_total": ("geo", "state", "state"),
    "msa_total": ("geo", "cbsa_title", "msa"),
}


def families_sql(names: list[str], metrics: list[str] = K.METRICS, cube: bool = False) -> str:
    """WITH-clause body (no leading 'with') defining ``{name}_out`` per family."""
    parts = [prepared_ctes(), cube_ctes(metrics) if cube else long_ctes(metrics)]
    for n in names:
        kind, geo, gt = FAMILIES[n]
        parts.append(family_ctes(n, kind, geo, gt, metrics, cube))
    return ",".join(parts)


def estimates_sql(names: list[str], metrics: list[str] = K.METRICS) -> str:
    union = " union all ".join(
        f"select {rounded(ESTIMATE_OUT, ESTIMATE_DOUBLES)} from {n}_out" for n in names)
    return "with " + families_sql(names, metrics) + "\n" + union


def us_total_ctes(metrics: list[str] = K.METRICS, cube: bool = False) -> str:
    """CTE ``ust_out``: national mean/SE per interval over non-NULL rows (A10)."""
    sums = ("sum(sw) as sw, sum(swx) as swx, cast(sum(n) as bigint) as n from lng_state" if cube
            else "sum(w) as sw, sum(w * x) as swx, count(*) as n from lng")
    return f"""
ust_s as (select interval_start, metric, rep, {sums} group by all),
ust_t as (select interval_start, metric, rep, n, swx / nullif(sw, 0) as t from ust_s),
ust_c as (select interval_start, metric, n, t as m from ust_t where rep = 0),
ust_out as (
  select 'wk' || c.interval_start || '_' || (c.interval_start + 1) as week_num,
         cast(c.interval_start as int) as interval_start, c.metric, c.m as mean,
         2 * sqrt(coalesce(sum(power(t.t - c.m, 2)), 0) / {R}) as se, c.n as n
  from ust_t t join ust_c c using (interval_start, metric)
  where t.rep > 0 group by c.interval_start, c.metric, c.m, c.n
)"""

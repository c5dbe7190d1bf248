"""Published summary tables: cell tables, normalisers and checks
(S7-S9, T1-T15, F6, F7, J11, E5, A18, C2-C5).

A published table is a cell table: per (table, file, sheet) a 'Total' row,
a header row 'Hispanic origin and Race' (no counts) and one row per race
label, with weighted counts in named columns. Here the cells are derived by
Spark from the microdata (FIXTURES.md section 4): weighted sums of the full
weight by answer code, non-response codes in their own column, zero counts
written as NULL. Sheets are 'US', each state and each metro
('<City>_Metro_Area').

Each table is a spec: universe, count columns (SQL predicates on respondent
rows) and derived columns (SQL expressions on counts). The normaliser is one
generic DataFrame function over any spec.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repweave import constants as K
from repweave.functions.scalar import extract_or_null, race_short_name, within

HEADER_LABEL = "Hispanic origin and Race"
RACE_ROWS = [K.RACE_LABEL_HISPANIC, K.RACE_LABEL_WHITE, K.RACE_LABEL_BLACK,
             K.RACE_LABEL_ASIAN, K.RACE_LABEL_OTHER]
NR = "in (-88, -99)"
AVAILABILITY = ["always_available", "usually_available", "sometimes_available", "rarely_available", "never_available"]


@dataclass(frozen=True)
class TableSpec:
    name: str
    counts: dict[str, str]                  # column -> SQL predicate on respondent rows
    derived: dict[str, str]                 # column -> SQL expression on counts
    keep: list[str]                         # output columns after the standard ones
    universe: str = "true"
    first_week: int = 1
    metric: str | None = None               # cube metric this table publishes
    numerator: str | None = None            # count columns for the check (A18)
    denominator: str | None = None
    extra: dict = field(default_factory=dict)
    optional: tuple[str, ...] = ()          # columns that files before ``optional_from`` lack
    optional_from: int = K.DRIFT_FIRST_WEEK
    file_names: dict[int, str] = field(default_factory=dict)  # weeks whose file has a name of its own

    def file(self, week):
        """The file name of a week (a column)."""
        name = F.concat(F.lit(self.name + "_wk"), week.cast("string"), F.lit(".xlsx"))
        for w, own in self.file_names.items():
            name = F.when(week == w, own).otherwise(name)
        return name

    def week_num(self, file):
        """The week label of a file name (a column)."""
        label = extract_or_null(file, r"_(.*?)\.xlsx")
        for w, own in self.file_names.items():
            label = F.when(file == own, f"wk{w}").otherwise(label)
        return label

    def layouts(self) -> dict[int, list[str]]:
        """The column names of a file by its number of value columns."""
        names = list(self.counts)
        return {len(c): c for c in (names, [n for n in names if n not in self.optional])}


def _food(name: str, suffix: str = "", metric: str | None = None) -> TableSpec:
    return TableSpec(
        name=name,
        counts={"total": "true", "enough": "curfoodsuf = 1", "enough_but_not_wanted": "curfoodsuf = 2",
                "sometimes_not_enough": "curfoodsuf = 3", "often_not_enough": "curfoodsuf = 4",
                "did_not_report": f"curfoodsuf {NR}"},
        derived={"total_answered": "total - did_not_report",
                 f"total_food_insecure{suffix}": "often_not_enough + sometimes_not_enough",
                 f"percent_food_insecure{suffix}":
                     f"(often_not_enough + sometimes_not_enough) / nullif(total - did_not_report, 0)",
                 "percent_answered": "(total - did_not_report) / nullif(total, 0)"},
        keep=[f"total_food_insecure{suffix}", "total_answered", "total",
              f"percent_food_insecure{suffix}", "percent_answered"],
        metric=metric, numerator=f"total_food_insecure{suffix}",
        denominator="total_answered")


SPECS: dict[str, TableSpec] = {s.name: s for s in [
    _food("food2b", metric="food_insufficient"),
    _food("food3b", "_children"),       # the children's table; no estimate is checked against it
    TableSpec(
        name="employ1",
        counts={"total": "true", "income_loss_since_mar_13": "wrkloss = 1",
                "no_income_loss_since_mar_13": "wrkloss = 2", "lost_not_reported": f"wrkloss {NR}",
                "income_loss_next_4_wks": "expctloss = 1", "no_income_loss_next_4_wks": "expctloss = 2",
                "lose_not_reported": f"expctloss {NR}"},
        derived={"total_answered_lost": "total - lost_not_reported",
                 "total_answered_lose": "total - lose_not_reported",
                 "perc_lost_income": "(income_loss_since_mar_13) / nullif(total - lost_not_reported, 0)",
                 "perc_lose_income": "(income_loss_next_4_wks) / nullif(total - lose_not_reported, 0)"},
        keep=["income_loss_since_mar_13", "total_answered_lost", "income_loss_next_4_wks",
              "total_answered_lose", "perc_lost_income", "perc_lose_income"],
        metric="inc_loss", numerator="income_loss_since_mar_13",
        denominator="total_answered_lost",
        extra={"second": ("expect_inc_loss", "income_loss_next_4_wks", "total_answered_lose")}),
    TableSpec(
        name="housing1b",
        counts={"total": "tenure in (3, 4)", "occup_no_rent": "tenure = 4",
                "payment_yes": "tenure = 3 and mortlmth = 1", "payment_no": "tenure = 3 and mortlmth = 2",
                "payment_deferred": "tenure = 3 and mortlmth = 3",
                "did_not_respond_conf": f"tenure = 3 and mortlmth {NR}",
                "owner_occupied": "tenure in (1, 2)", "did_not_respond_tenure": "tenure not in (1, 2, 3, 4)"},
        derived={"total_not_paid": "payment_no + payment_deferred",
                 "total_answered": "total - occup_no_rent - did_not_respond_conf",
                 "perc_rent_not_paid": "(payment_no + payment_deferred) / nullif("
                                       "total - occup_no_rent - did_not_respond_conf, 0)",
                 # as first published: the division binds to the deferred payments alone
                 "perc_rent_not_paid_raw": "payment_no + payment_deferred / nullif("
                                           "total - occup_no_rent - did_not_respond_conf, 0)"},
        keep=["payment_no", "payment_yes", "payment_deferred", "total", "did_not_respond_conf",
              "did_not_respond_tenure", "total_not_paid", "total_answered", "perc_rent_not_paid",
              "perc_rent_not_paid_raw"],
        metric="rent_not_paid", numerator="total_not_paid", denominator="total_answered",
        optional=("owner_occupied",)),
    TableSpec(
        name="housing2a",
        counts={"total": "tenure in (1, 2)", "owned_free_clear": "tenure = 1",
                "no_conf": "tenure = 2 and mortconf = 1", "slight_conf": "tenure = 2 and mortconf = 2",
                "moderate_conf": "tenure = 2 and mortconf = 3", "high_conf": "tenure = 2 and mortconf = 4",
                "deferred": "tenure = 2 and mortconf = 5",
                "no_response_conf": f"tenure = 2 and mortconf {NR}",
                "renter_occupied": "tenure in (3, 4)", "did_not_respond_tenure": "tenure not in (1, 2, 3, 4)"},
        derived={"total_not_conf": "no_conf + slight_conf + deferred",
                 "total_answered": "total - owned_free_clear - no_response_conf",
                 "perc_not_conf": "(no_conf + slight_conf + deferred) / nullif("
                                  "total - owned_free_clear - no_response_conf, 0)"},
        keep=["did_not_respond_tenure", "total_not_conf", "total_answered", "perc_not_conf"],
        metric="mortgage_not_conf", numerator="total_not_conf", denominator="total_answered",
        optional=("renter_occupied",)),
    TableSpec(
        name="housing2b",
        counts={"total": "tenure in (3, 4)", "occup_no_rent": "tenure = 4",
                "no_conf": "tenure = 3 and mortconf = 1", "slight_conf": "tenure = 3 and mortconf = 2",
                "moderate_conf": "tenure = 3 and mortconf = 3", "high_conf": "tenure = 3 and mortconf = 4",
                "deferred": "tenure = 3 and mortconf = 5",
                "no_response_conf": f"tenure = 3 and mortconf {NR}",
                "owner_occupied": "tenure in (1, 2)", "did_not_respond_tenure": "tenure not in (1, 2, 3, 4)"},
        derived={"total_not_conf": "no_conf + slight_conf + deferred",
                 "total_answered": "total - occup_no_rent - no_response_conf",
                 "perc_not_conf": "(no_conf + slight_conf + deferred) / nullif("
                                  "total - occup_no_rent - no_response_conf, 0)"},
        keep=["did_not_respond_tenure", "total_not_conf", "total_answered", "perc_not_conf"],
        metric="rent_not_conf", numerator="total_not_conf", denominator="total_answered",
        optional=("owner_occupied",)),
    TableSpec(
        name="stimulus1", first_week=K.DRIFT_FIRST_WEEK,
        counts={"total": "true", "used_expenses": "eip = 1", "used_debt": "eip = 2",
                "used_savings": "eip = 3", "payment_not_received": "eip = 4",
                "did_not_respond": f"eip {NR}"},
        derived={"total_answered": "total - payment_not_received - did_not_respond",
                 "perc_used_expenses": "(used_expenses) / nullif("
                                       "total - payment_not_received - did_not_respond, 0)"},
        keep=["used_expenses", "total_answered", "perc_used_expenses"],
        metric="stimulus_expenses", numerator="used_expenses", denominator="total_answered"),
    TableSpec(
        name="health2a",
        counts={"nervous_not_at_all": "anxious = 1", "nervous_several_days": "anxious = 2",
                "nervous_half_days": "anxious = 3", "nervous_nearly_every_day": "anxious = 4",
                "nervous_no_response": f"anxious {NR}",
                "worry_not_at_all": "worry = 1", "worry_several_days": "worry = 2",
                "worry_half_days": "worry = 3", "worry_nearly_every_day": "worry = 4",
                "worry_no_response": f"worry {NR}"},
        derived={"total_anxious": "nervous_several_days + nervous_half_days + nervous_nearly_every_day",
                 "total_answered": "nervous_not_at_all + nervous_several_days + nervous_half_days"
                                   " + nervous_nearly_every_day",
                 "perc_anxious": "(nervous_several_days + nervous_half_days + "
                                 "nervous_nearly_every_day) / nullif(nervous_not_at_all + nervous_several_days"
                                 " + nervous_half_days + nervous_nearly_every_day, 0)"},
        keep=["total_anxious", "total_answered", "perc_anxious"]),
    TableSpec(
        name="health2b",
        counts={"interest_not_at_all": "interest = 1", "interest_several_days": "interest = 2",
                "interest_half_days": "interest = 3", "interest_nearly_every_day": "interest = 4",
                "interest_no_response": f"interest {NR}",
                "down_not_at_all": "down = 1", "down_several_days": "down = 2",
                "down_half_days": "down = 3", "down_nearly_every_day": "down = 4",
                "down_no_response": f"down {NR}"},
        derived={"total_down": "down_several_days + down_half_days + down_nearly_every_day",
                 "total_answered": "down_not_at_all + down_several_days + down_half_days"
                                   " + down_nearly_every_day",
                 "perc_down": "(down_several_days + down_half_days + down_nearly_every_day) / nullif("
                              " down_not_at_all + down_several_days + down_half_days"
                              " + down_nearly_every_day, 0)"},
        keep=["total_down", "total_answered", "perc_down"], file_names={2: "health2b_wk2-full.xlsx"}),
    TableSpec(
        name="health3", universe="tbirth_year >= 1956",
        counts={"total_insured": "uninsured = 0", "private": "uninsured = 0 and insured_public = 0",
                "public": "insured_public = 1", "uninsured": "uninsured = 1",
                "not_reported": "uninsured is null"},
        derived={"perc_public": "(public) / nullif(total_insured, 0)",
                 "perc_uninsured": "(uninsured) / nullif(uninsured + total_insured, 0)"},
        keep=["public", "total_insured", "uninsured", "perc_public", "perc_uninsured"],
        ),
    TableSpec(
        name="educ2", universe="teach1 <> -88",
        counts={"total": "true", "cancelled": "teach1 = 1", "online": "teach2 = 1",
                "paper": "teach3 = 1", "changed_other": "teach4 = 1", "unchanged": "teach5 = 1",
                "did_not_report": "teach1 = -99 and teach2 = -99 and teach3 = -99 and teach4 = -99"
                                  " and teach5 = -99"},
        derived={"total_answered": "total - did_not_report",
                 "perc_cancelled": "(cancelled) / nullif(total - did_not_report, 0)",
                 "perc_online": "(online) / nullif(total - did_not_report, 0)",
                 "perc_paper": "(paper) / nullif(total - did_not_report, 0)"},
        keep=["total", "total_answered", "perc_cancelled", "perc_online", "perc_paper"]),
    TableSpec(
        name="educ3",
        counts={"total": "true",
                **{f"{what}_{label}": f"{code} = {i}" for what, code in (("device", "device"), ("internet", "intrnt"))
                   for i, label in enumerate(AVAILABILITY, 1)},
                "device_did_not_respond": f"device {NR}", "internet_did_not_respond": f"intrnt {NR}"},
        derived={k: v for what in ("device", "internet") for k, v in {
            f"{what}_total_answered": f"total - {what}_did_not_respond",
            f"perc_{what[:3]}_unavail": f"({what}_rarely_available + {what}_never_available) / nullif("
                                        f"total - {what}_did_not_respond, 0)",
            f"{what}_percent_answered": f"(total - {what}_did_not_respond) / nullif(total, 0)"}.items()},
        keep=["device_rarely_available", "device_never_available", "device_total_answered",
              "internet_rarely_available", "internet_never_available", "internet_total_answered",
              "perc_dev_unavail", "perc_int_unavail", "total", "device_percent_answered",
              "internet_percent_answered"]),
    TableSpec(
        name="health1",
        counts={"delayed_med_care_did_not_get": "delay = 1", "delayed_med_care_did_get": "delay = 2",
                "delayed_med_care_did_not_report": f"delay {NR}", "needed_med_care_did_not_get": "notget = 1",
                "needed_med_care_did_get": "notget = 2", "needed_med_care_did_not_report": f"notget {NR}"},
        derived={"perc_not_get_med_care": "needed_med_care_did_not_get / nullif("
                                          "needed_med_care_did_not_get + needed_med_care_did_get, 0)"},
        keep=["needed_med_care_did_get", "needed_med_care_did_not_get", "needed_med_care_did_not_report",
              "perc_not_get_med_care"]),
    TableSpec(
        name="employ2",
        counts={"total": "true",
                **{kind: f"anywork = 1 and kindwork = {i}" for i, kind in enumerate(
                    ("government", "private", "nonprofit", "self_employed", "fam_business"), 1)},
                "employed_did_not_respond": f"anywork = 1 and kindwork {NR}", "not_employed": "anywork = 2",
                "did_not_respond": f"anywork {NR}"},
        derived={"entrepreneurship_health": "(self_employed + fam_business) / nullif("
                                            "total - employed_did_not_respond - did_not_respond, 0)"},
        keep=["entrepreneurship_health"]),
]}


# ------------------------------------------------------------------ cells ---

def _race_label_row(label_col: str):
    order = F.lit(None).cast("int")
    for i, lab in enumerate(RACE_ROWS):
        order = F.when(F.col(label_col) == lab, F.lit(i + 2)).otherwise(order)
    return order


def _by_sheet(src: DataFrame, aggs: list) -> DataFrame:
    """(week, sheet, variable, aggregates): one aggregation over six grouping sets,
    (US | state | metro) x (Total row | race rows)."""
    sheet_of_metro = F.create_map(*[x for title, _, sheet in K.METRO_AREAS
                                    for x in (F.lit(title), F.lit(sheet))])
    src = src.withColumn("metro_sheet", F.element_at(sheet_of_metro, F.col("cbsa_title")))
    sets = [["week", "state", "hisp_rrace"], ["week", "metro_sheet", "hisp_rrace"],
            ["week", "hisp_rrace"], ["week", "state"], ["week", "metro_sheet"], ["week"]]
    g = src.groupingSets(sets, "week", "state", "metro_sheet", "hisp_rrace").agg(
        F.grouping("state").alias("_gs"), F.grouping("metro_sheet").alias("_gm"),
        F.grouping("hisp_rrace").alias("_gr"), *aggs)
    sheet = (F.when(F.col("_gs") == 0, F.col("state"))
             .when(F.col("_gm") == 0, F.col("metro_sheet")).otherwise(F.lit("US")))
    variable = F.when(F.col("_gr") == 1, F.lit("Total")).otherwise(F.col("hisp_rrace"))
    return (g.where(sheet.isNotNull() & variable.isNotNull())
            .withColumns({"sheet": sheet, "variable": variable})
            .drop("state", "metro_sheet", "hisp_rrace", "_gs", "_gm", "_gr"))


def _with_headers(body: DataFrame) -> DataFrame:
    """The rows with their place on the sheet; a header row stands behind each Total row: one
    more row out of the same pass."""
    order = F.when(F.col("variable") == "Total", F.lit(0)).otherwise(_race_label_row("variable"))
    return body.withColumn("row_idx", F.explode(F.when(order == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(order))))


def _count(pred):
    return F.nullif(F.sum(F.when(pred, F.col("pweight"))), F.lit(0.0))


def cell_table(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Published cell table of one spec, from recoded respondent rows with
    ``state``, ``cbsa_title`` and ``hisp_rrace``; counts are weighted sums, zero -> NULL."""
    src = rows.where(F.expr(spec.universe) & (F.col("week") >= spec.first_week))
    body = _by_sheet(src, [_count(F.expr(pred)).alias(c) for c, pred in spec.counts.items()])
    rows = _with_headers(body.withColumns({"table": F.lit(spec.name), "file": spec.file(F.col("week"))}))
    head = F.col("row_idx") == 1
    return rows.select("table", "file", "sheet", F.when(head, HEADER_LABEL).otherwise(F.col("variable")).alias("variable"),
                       *[F.when(~head, F.col(c)).alias(c) for c in spec.counts], "row_idx")


#: Sums of one aggregation; beyond 100 columns Spark leaves generated code.
PASS_SUMS = 90


def _passes(specs: Iterable[TableSpec], most: int) -> list[list[TableSpec]]:
    out, held = [[]], 0
    for s in specs:
        if held and held + len(s.counts) + 1 > most:
            out.append([])
            held = 0
        out[-1].append(s)
        held += len(s.counts) + 1
    return out


def cell_tables(rows: DataFrame, specs: Iterable[TableSpec], most: int = PASS_SUMS) -> DataFrame:
    """The cell tables of several specs as one mixed table of positional cells (table, file, sheet,
    variable, row_idx, cells): the respondents are read and grouped once for all specs whose sums fit
    ``most``, not once per spec. A row stands where a spec's universe has respondents."""
    out = None
    for part in _passes(specs, most):
        aggs, tables = [], []
        for s in part:
            here = F.expr(s.universe) & (F.col("week") >= s.first_week)
            aggs.append(F.max(F.when(here, F.lit(True))).alias(f"{s.name}__has"))
            aggs += [_count(here & F.expr(pred)).alias(f"{s.name}__{c}") for c, pred in s.counts.items()]
            cells = {w: F.array(*[F.col(f"{s.name}__{c}").cast("double") for c in names]) for w, names in s.layouts().items()}
            wide, narrow = cells[max(cells)], cells[min(cells)]
            tables.append(F.when(F.col(f"{s.name}__has"), F.struct(
                F.lit(s.name).alias("table"), s.file(F.col("week")).alias("file"),
                F.when(F.col("week") < s.optional_from, narrow).otherwise(wide).alias("cells"))))
        body = _by_sheet(rows, aggs).select("sheet", "variable", F.explode(F.array_compact(F.array(*tables))).alias("t"))
        got = _with_headers(body.select("t.table", "t.file", "sheet", "variable", "t.cells"))
        empty = F.transform("cells", lambda _: F.lit(None).cast("double"))
        head = F.col("row_idx") == 1
        got = got.select("table", "file", "sheet", F.when(head, HEADER_LABEL).otherwise(F.col("variable")).alias("variable"),
                         "row_idx", F.when(head, empty).otherwise(F.col("cells")).alias("cells"))
        out = got if out is None else out.unionByName(got)
    return out


def positional(cells: DataFrame, spec: TableSpec) -> DataFrame:
    """The cells as a file has them: an array c1..cN per row, without names. Files of weeks
    before ``spec.optional_from`` lack the optional columns and so are narrower."""
    wide, narrow = list(spec.counts), [c for c in spec.counts if c not in spec.optional]
    week = F.regexp_extract("file", r"_wk(\d+)", 1).cast("int")
    values = lambda names: F.array(*[F.col(n).cast("double") for n in names])
    cell = values(wide) if not spec.optional else F.when(week < spec.optional_from, values(narrow)).otherwise(values(wide))
    return cells.select("table", "file", "sheet", "variable", "row_idx", cell.alias("cells"))


def choose_layout(cells: DataFrame, layouts: dict[int, list[str]]) -> DataFrame:
    """Names for positional cells, by the number of value columns of each row's file. A
    column that a layout lacks is NULL; a width without a layout is an error."""
    width = F.size("cells")
    names = list(dict.fromkeys(n for w in sorted(layouts, reverse=True) for n in layouts[w]))
    out = {}
    for name in names:
        value = F.lit(None).cast("double")
        for n, layout in layouts.items():
            if name in layout:
                value = F.when(width == n, F.get("cells", layout.index(name))).otherwise(value)
        out[name] = value
    known = F.when(width.isin(*layouts), F.col("cells")).otherwise(
        F.raise_error(F.concat(F.lit("no layout for "), F.col("file"))).cast("array<double>"))
    return cells.withColumn("cells", known).withColumns(out).drop("cells")


# ------------------------------------------------------------- normaliser ---

def normalise(cells: DataFrame, spec: TableSpec) -> DataFrame:
    """T1-T14 + T15: race rows only, NULL counts -> 0, derived columns, header
    dropped, geography from the sheet (metro sheets -> full titles), week from
    the file name, race label -> short name."""
    counts = list(spec.counts)
    if "cells" in cells.columns:
        cells = choose_layout(cells, spec.layouts())
    d = (cells.where(F.col("variable").contains("Hispanic"))                       # F6
         .fillna(0.0, subset=counts))                                              # NULL -> 0
    w = Window.partitionBy("file", "sheet").orderBy("row_idx")
    d = d.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") > 1)          # F7
    d = d.withColumns({k: F.expr(v) for k, v in spec.derived.items()})
    return d.select("variable", _geography().alias("geography"), *spec.keep,
                    spec.week_num(F.col("file")).alias("week_num"),                 # E5
                    race_short_name(F.col("variable")).alias("race_var"))           # P46


def _geography():
    """The geography of a sheet, metro sheets by their full titles."""
    metro_title = F.create_map(*[x for title, _, sheet in K.METRO_AREAS
                                 for x in (F.lit(sheet), F.lit(title))])
    return F.when(F.col("sheet").contains("Metro_Area"),
                  F.element_at(metro_title, F.col("sheet"))).otherwise(F.col("sheet"))


def dispatch(cells: DataFrame, specs: dict[str, TableSpec] | None = None) -> DataFrame:
    """A mixed table of positional cells, each row normalised by the spec that its ``table`` names, in one
    pass: (table, variable, geography, week_num, race_var, measure, value), a row per kept measure.

    A table without a spec, or a width that its spec has no layout for, is an error."""
    specs = SPECS if specs is None else specs
    table, width = F.col("table"), F.size("cells")
    is_of = {s.name: table == s.name for s in specs.values()}
    known, week_num, kept = F.lit(False), F.lit(None).cast("string"), None
    for s in specs.values():
        week_num = F.when(is_of[s.name], s.week_num(F.col("file"))).otherwise(week_num)
        for n, layout in s.layouts().items():
            here = is_of[s.name] & (width == n)
            known = known | here
            # an expression's names are places of this layout; a column it lacks counts 0
            place = {c: f"coalesce(get(cells, {layout.index(c)}), 0D)" if c in layout else "0D" for c in s.counts}
            value = lambda k: F.expr(re.sub(r"\w+", lambda m: place.get(m[0], m[0]), s.derived.get(k, k)))  # noqa: B023, E731
            measures = F.array(*[F.struct(F.lit(k).alias("measure"), value(k).cast("double").alias("value")) for k in s.keep])
            kept = F.when(here, measures) if kept is None else kept.when(here, measures)
    checked = F.when(F.coalesce(known, F.lit(False)), F.col("cells")).otherwise(
        F.raise_error(F.concat(F.lit("no layout for "), F.coalesce("file", "table", F.lit("NULL")))).cast("array<double>"))
    d = cells.withColumn("cells", checked).where(F.col("variable").contains("Hispanic"))          # F6
    w = Window.partitionBy("table", "file", "sheet").orderBy("row_idx")
    d = d.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") > 1)                       # F7
    return (d.select("table", "variable", _geography().alias("geography"), week_num.alias("week_num"),
                     race_short_name(F.col("variable")).alias("race_var"), F.explode(kept).alias("_m"))
            .select("table", "variable", "geography", "week_num", "race_var", "_m.measure", "_m.value"))


# ------------------------------------------------------------------ checks ---

def published_means(norm: DataFrame, crosswalk: DataFrame, num: str, den: str,
                    metric: str) -> DataFrame:
    """A18 / J9 over the week crosswalk: pooled ratio of published counts per
    (interval, geography, race), with the number of its weeks that were published.

    A full join: a published week that no interval holds stays, under its own label;
    an interval without a published week has no row here and is one-sided in the check.
    """
    j = norm.join(crosswalk.select("week_num", "week_int"), "week_num", "full").where(F.col("variable").isNotNull())
    g = j.groupBy(F.coalesce("week_int", "week_num").alias("week_num"), "geography", "race_var").agg(
        F.sum(num).alias("sum_num"), F.sum(den).alias("sum_den"),
        F.countDistinct("week_num").alias("n_weeks"))
    return g.select("week_num", "geography", "race_var", F.lit(metric).alias("metric"),
                    F.try_divide(F.col("sum_num"), F.col("sum_den")).alias("published_mean"), "n_weeks")


def published_means_of(measures: DataFrame, crosswalk: DataFrame,
                       parts: list[tuple[TableSpec, str, str, str]]) -> DataFrame:
    """``published_means`` of many metrics in one join and one aggregation, from dispatched measures;
    parts: (spec, metric, numerator, denominator)."""
    uses = None
    for what, at in (("num", 2), ("den", 3)):
        for p in parts:
            use = F.when((F.col("table") == p[0].name) & (F.col("measure") == p[at]),
                         F.struct(F.lit(p[1]).alias("metric"), F.lit(what).alias("what")))
            uses = [use] if uses is None else [*uses, use]
    d = measures.withColumn("_u", F.explode(F.array_compact(F.array(*uses))))
    j = d.join(F.broadcast(crosswalk.select("week_num", "week_int")), "week_num", "left")  # two rows a week at most
    g = j.groupBy(F.coalesce("week_int", "week_num").alias("week_num"), "geography", "race_var", F.col("_u.metric").alias("metric")).agg(
        *[F.sum(F.when(F.col("_u.what") == w, F.col("value"))).alias(w) for w in ("num", "den")],
        F.countDistinct("week_num").alias("n_weeks"))
    return g.select("week_num", "geography", "race_var", "metric", F.try_divide("num", "den").alias("published_mean"), "n_weeks")


def check_against_published(estimates: DataFrame, published: DataFrame,
                            tol: float = K.QC_TOLERANCE, digits: int = 4) -> DataFrame:
    """Our means vs published ratios; both, rounded to 4 digits, are within tol.

    Every cell of either side comes back with a status: ``both``, ``estimate_only``,
    ``published_only``, or ``incomplete_interval`` where only one of an interval's two weeks
    was published. ``ok`` is judged on ``both`` alone, and is NULL where a side has no mean.
    """
    keys = ["geography", "week_num", "race_var", "metric"]
    j = (estimates.select(*keys, "mean", F.lit(1).alias("_e"))
         .join(published.select(*keys, "published_mean", "n_weeks"), keys, "full"))
    ours, theirs = F.round("mean", digits), F.round("published_mean", digits)
    status = (F.when(F.col("n_weeks").isNull(), "estimate_only").when(F.col("_e").isNull(), "published_only")
              .when(F.col("n_weeks") < 2, "incomplete_interval").otherwise("both"))
    ok = F.when((status == "both") & ours.isNotNull() & theirs.isNotNull(), within(ours, theirs, tol))
    return j.select(*keys, "mean", "published_mean", status.alias("status"), ok.alias("ok"))

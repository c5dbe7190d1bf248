"""Per-row recodes of survey answers into 0/1/NULL indicators.

Every function returns a Column expression, so a whole recode pass is one
``withColumns`` -> one Project inside whole-stage codegen. ``CASE`` takes the
first true branch and treats NULL as not true, which is exactly the
first-match rule the indicators are specified with. Results are DOUBLE.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from repweave import constants as K


def _null() -> Column:
    return F.lit(None).cast("double")


def _any(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, cols)


def _all(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, cols)


def c(name: str) -> Column:
    return F.col(name)


def hisp_rrace() -> Column:
    """P3 + P4: race label; Hispanic ethnicity overrides race."""
    race = (F.when(c("rrace") == 1, K.RACE_LABEL_WHITE)
            .when(c("rrace") == 2, K.RACE_LABEL_BLACK)
            .when(c("rrace") == 3, K.RACE_LABEL_ASIAN)
            .when(c("rrace") == 4, K.RACE_LABEL_OTHER))
    return F.when(c("rhispanic") == 2, F.lit(K.RACE_LABEL_HISPANIC)).otherwise(race)


def uninsured() -> Column:
    """P5: any of plans 1-6 -> 0; all of 1-6 answered 'no' -> 1; IHS only -> 1."""
    h = [c(f"hlthins{i}") for i in range(1, 7)]
    return (F.when(_any([x == 1 for x in h]), 0.0)
            .when(_all([x == 2 for x in h]), 1.0)
            .when(c("hlthins7") == 1, 1.0)
            .otherwise(_null()))


def insured_public() -> Column:
    """Medicare/Medicaid/VA -> 1; all eight -99 or all -88 -> NULL; else 0."""
    h = [c(f"hlthins{i}") for i in range(1, 9)]
    return (F.when((c("hlthins3") == 1) | (c("hlthins4") == 1) | (c("hlthins6") == 1), 1.0)
            .when(_all([x == -99 for x in h]), _null())
            .when(_all([x == -88 for x in h]), _null())
            .otherwise(0.0))


def yes_no(col: str) -> Column:
    """1 -> 1, 2 -> 0, else NULL."""
    return F.when(c(col) == 1, 1.0).when(c(col) == 2, 0.0).otherwise(_null())


def payment_not_conf(tenure: int | None = None) -> Column:
    """little/no confidence or deferred -> 1, moderate/high -> 0."""
    yes = c("mortconf").isin(1, 2, 5)
    no = c("mortconf").isin(3, 4)
    if tenure is not None:
        yes = yes & (c("tenure") == tenure)
        no = no & (c("tenure") == tenure)
    return F.when(yes, 1.0).when(no, 0.0).otherwise(_null())


def not_paid(tenure: int) -> Column:
    """Not paid or deferred -> 1, paid -> 0, within one tenure."""
    t = c("tenure") == tenure
    return (F.when(c("mortlmth").isin(2, 3) & t, 1.0)
            .when((c("mortlmth") == 1) & t, 0.0).otherwise(_null()))


def food_insufficient() -> Column:
    """P14."""
    return (F.when(c("curfoodsuf").isin(3, 4), 1.0)
            .when(c("curfoodsuf").isin(1, 2), 0.0).otherwise(_null()))


def classes_cancelled() -> Column:
    """teach1 = 1 -> 1; any teach answered (>= 0) -> 0."""
    return (F.when(c("teach1") == 1, 1.0)
            .when(_any([c(f"teach{i}") >= 0 for i in range(1, 6)]), 0.0)
            .otherwise(_null()))


def stimulus_expenses() -> Column:
    """Eip 1 -> 1, 2/3 -> 0, else (incl. 4 = not received) NULL."""
    return (F.when(c("eip") == 1, 1.0).when(c("eip").isin(2, 3), 0.0)
            .otherwise(_null()))


def spend_source(i: int) -> Column:
    """spndsrc{i} = 1 -> 1; any spending source answered -> 0."""
    return (F.when(c(f"spndsrc{i}") == 1, 1.0)
            .when(_any([c(f"spndsrc{j}") >= 0 for j in range(1, 8)]), 0.0)
            .otherwise(_null()))


def score(col: str) -> Column:
    """Answer 1..4 -> score 0..3."""
    return F.when(c(col).isin(1, 2, 3, 4), c(col).cast("double") - 1.0).otherwise(_null())


def signs(a: Column, b: Column) -> Column:
    """NULL-ignoring sum >= 3 -> 1; both NULL -> NULL; else 0."""
    total = F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0))
    return (F.when(total >= 3, 1.0).when(a.isNull() & b.isNull(), _null())
            .otherwise(0.0))


def either_sign(a: Column, b: Column) -> Column:
    """either = 1 -> 1; both NULL -> NULL; else 0."""
    return (F.when((a == 1) | (b == 1), 1.0).when(a.isNull() & b.isNull(), _null())
            .otherwise(0.0))


def recode_columns() -> dict[str, Column]:
    """All indicator columns of the prepare step, in output order.

    Mental-health signs are written in terms of the score expressions so the
    dict has no intra-dependencies and stays one Project.
    """
    anx, wor = score("anxious"), score("worry")
    inte, down = score("interest"), score("down")
    anxiety = signs(anx, wor)
    depression = signs(inte, down)
    return {
        "hisp_rrace": hisp_rrace(),
        "uninsured": uninsured(),
        "insured_public": insured_public(),
        "inc_loss": yes_no("wrkloss"),
        "expect_inc_loss": yes_no("expctloss"),
        "payment_not_conf": payment_not_conf(),
        "rent_not_conf": payment_not_conf(3),
        "mortgage_not_conf": payment_not_conf(2),
        "rent_not_paid": not_paid(3),
        "mortgage_not_paid": not_paid(2),
        "food_insufficient": food_insufficient(),
        "classes_cancelled": classes_cancelled(),
        "stimulus_expenses": stimulus_expenses(),
        "spend_credit": spend_source(2),
        "spend_savings": spend_source(3),
        "spend_ui": spend_source(5),
        "spend_stimulus": spend_source(6),
        "anxious_score": anx,
        "worry_score": wor,
        "interest_score": inte,
        "down_score": down,
        "anxiety_signs": anxiety,
        "depression_signs": depression,
        "depression_anxiety_signs": either_sign(anxiety, depression),
    }


def age_rule(col: str, birth_year_before: int = 1956) -> Column:
    """Insurance metrics only for respondents born in/after 1956; NULL year keeps."""
    return F.when(c("tbirth_year") < birth_year_before, _null()).otherwise(c(col))


def race_indicator(name: str) -> Column:
    """1 if hisp_rrace contains the group's marker, else 0 (NULL -> 0)."""
    return F.when(c("hisp_rrace").contains(K.RACE_PATTERNS[name]), 1).otherwise(0)


def race_group() -> Column:
    """Single race group per respondent (first matching marker), NULL if none.

    The five markers are mutually exclusive over the fixed labels, so this is
    the column form of the five 0/1 indicators: a respondent is in group g
    exactly when ``race_indicator(g) == 1``. NULL belongs to every complement.
    """
    expr = None
    for name in K.RACE_GROUPS:
        cond = c("hisp_rrace").contains(K.RACE_PATTERNS[name])
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr

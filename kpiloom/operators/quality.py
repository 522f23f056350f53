"""Data-quality checks (unique, not_null, accepted_values, relationships, range).

Each single check returns its *failing rows* as a DataFrame: empty means pass.
Null passes every check except ``not_null``.  What counts as one failure:

* ``unique``: one row per duplicated non-null value (value, n_records);
* ``not_null``: every null row;
* ``accepted_values``: one row per distinct value outside the list;
* ``relationships``: every child row whose non-null key has no parent;
* ``between``: every row outside the range.

:func:`run_checks` evaluates a whole suite and returns one summary row per
check ``(model, column_name, check_name, failures)``.  All per-row checks of one
model share at most two aggregations; each relationship check is an anti-join.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Dict, Iterable, List, Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# ---------------------------------------------------------------------------
# single checks: failing rows
# ---------------------------------------------------------------------------

def unique(df: DataFrame, col: str) -> DataFrame:
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def accepted_values(df: DataFrame, col: str, values: Sequence,
                    where: Optional[str] = None) -> DataFrame:
    rows = df.filter(F.expr(where)) if where else df
    return (rows.groupBy(F.col(col).alias("value_field"))
            .agg(F.count(F.lit(1)).alias("n_records"))
            .filter(~F.col("value_field").cast("string").isin([str(v) for v in values])))


def relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    keys = parent.select(F.col(parent_col).alias("_dq_parent")).distinct()
    return (child.filter(F.col(col).isNotNull())
            .join(keys, F.col(col) == F.col("_dq_parent"), "left_anti"))


def _outside(col: str, min_value=None, max_value=None, strictly: bool = False) -> Column:
    c = F.col(col)
    ok = F.lit(True)
    if min_value is not None:
        ok = ok & ((c > min_value) if strictly else (c >= min_value))
    if max_value is not None:
        ok = ok & ((c < max_value) if strictly else (c <= max_value))
    return ~ok


def between(df: DataFrame, col: str, min_value=None, max_value=None,
            strictly: bool = False) -> DataFrame:
    return df.filter(_outside(col, min_value, max_value, strictly))


# ---------------------------------------------------------------------------
# suites
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Check:
    model: str
    column: str
    kind: str  # unique | not_null | accepted_values | relationships | between
    values: tuple = ()
    where: Optional[str] = None
    parent: Optional[str] = None
    parent_column: Optional[str] = None
    min_value: Optional[float] = None
    max_value: Optional[float] = None
    strictly: bool = False


_PER_MODEL = ("unique", "not_null", "accepted_values", "between")

SUMMARY_SCHEMA = "model string, column_name string, check_name string, failures bigint"


def _q(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _outside_sql(c: Check) -> str:
    conds = []
    if c.min_value is not None:
        conds.append(f"`{c.column}` {'>' if c.strictly else '>='} {c.min_value!r}")
    if c.max_value is not None:
        conds.append(f"`{c.column}` {'<' if c.strictly else '<='} {c.max_value!r}")
    return f"NOT ({' AND '.join(conds) or 'true'})"


def _value_item_sql(i: int, c: Check) -> str:
    """SQL: ``(check id, value)`` where a row's value counts towards check ``c``."""
    col = f"`{c.column}`"
    value = f"CAST({col} AS STRING)"
    if c.kind == "unique":
        hit = f"{col} IS NOT NULL"
    else:  # accepted_values
        hit = f"NOT ({value} IN ({', '.join(_q(str(v)) for v in c.values)}))"
        if c.where:
            hit = f"({hit}) AND ({c.where})"
    return f"CASE WHEN {hit} THEN named_struct('cid', {i}, 'v', {value}) END"


def _laid_out(counted: DataFrame, measures) -> DataFrame:
    """One row per check from a single row of measures, zeros included."""
    rows = ", ".join(
        f"named_struct('model', {_q(c.model)}, 'column_name', {_q(c.column)}, 'check_name', "
        f"{_q(c.kind)}, 'failures', CAST(COALESCE({m}, 0L) AS BIGINT))" for c, m in measures)
    return counted.agg(F.expr(f"array({rows}) AS r")).selectExpr("explode(r) AS r").selectExpr("r.*")


def _model_pass(df: DataFrame, checks: List[Check]) -> List[DataFrame]:
    """The per-row checks of one model: at most two aggregations.

    ``not_null`` and ``between`` are counts over the rows, one partial aggregate.
    ``unique`` and ``accepted_values`` count values: a row emits ``(check id,
    value)`` for each of them that it counts towards (every non-null key, or a bad
    value), and a partial + final aggregate gives duplicated or distinct bad ones.
    """
    plain = [c for c in checks if c.kind in ("not_null", "between")]
    valued = [c for c in checks if c.kind in ("unique", "accepted_values")]
    out = []
    if plain:
        out.append(_laid_out(df, [(c, f"count_if(`{c.column}` IS NULL)" if c.kind == "not_null"
                                   else f"count_if({_outside_sql(c)})") for c in plain]))
    if valued:
        items = ", ".join(_value_item_sql(i, c) for i, c in enumerate(valued))
        per_value = (df.selectExpr(f"explode(array({items})) AS p")
                     .filter("p IS NOT NULL")
                     .groupBy("p.cid", "p.v").agg(F.expr("count(1) AS n")))
        out.append(_laid_out(per_value, [
            (c, f"count_if(cid = {i} AND n > 1)" if c.kind == "unique" else f"count_if(cid = {i})")
            for i, c in enumerate(valued)]))
    return out


def _count_rows(df: DataFrame, c: Check) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(c.model).alias("model"), F.lit(c.column).alias("column_name"),
        F.lit(c.kind).alias("check_name"), F.col("failures").cast("long"))


def run_checks(frames: Dict[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """Evaluate ``checks`` against ``frames`` (model name → DataFrame).

    Per-row checks are grouped per model; each relationship
    check is an anti-join against the parent's distinct keys.
    """
    checks = list(checks)
    parts = []
    by_model: Dict[str, List[Check]] = {}
    for c in checks:
        if c.kind in _PER_MODEL:
            by_model.setdefault(c.model, []).append(c)
    for model, group in by_model.items():
        parts.extend(_model_pass(frames[model], group))
    for c in checks:
        if c.kind == "relationships":
            parts.append(_count_rows(relationships(frames[c.model], c.column,
                                                   frames[c.parent], c.parent_column), c))
    return reduce(lambda a, b: a.unionByName(b), parts)


def failed(summary: DataFrame) -> DataFrame:
    """Only the checks with at least one failure."""
    return summary.filter(F.col("failures") > 0)


# ---------------------------------------------------------------------------
# the declared suite: 55 staging + 13 mart checks
# ---------------------------------------------------------------------------

# Accepted value lists of the declared schema tests.
COUNTRIES = ("DK", "NO", "SE", "DE", "NL", "US")
SEGMENTS = ("SMB", "MID", "ENT")
PLANS = ("basic", "premium", "enterprise")
CHURN_REASONS = ("price_too_high", "competitor", "not_using")
LEAD_STATUSES = ("converted", "pending", "unassigned", "lost")
INVOICE_STATUSES = ("paid", "overdue", "paid_late")
PARTNER_STATUSES = ("active", "inactive")
NPS_CATEGORIES = ("promoter", "passive", "detractor")
UPSELL_TYPES = ("plan_upgrade", "add_on_sale", "unknown")
RECORD_TYPES = {
    "mart_churn": ("monthly_churn_summary", "at_risk_customer"),
    "mart_upselling": ("monthly_upsell_performance", "attach_rate_by_segment"),
    "mart_debt_collection": ("monthly_debt_summary", "aging_breakdown", "high_risk_debtors"),
    "mart_customer_satisfaction": ("nps_monthly", "detractor_detail", "response_rate"),
}


def _nn(model, *cols):
    return [Check(model, c, "not_null") for c in cols]


def _av(model, col, values, where=None):
    return Check(model, col, "accepted_values", tuple(values), where=where)


def _rel(model, col):
    return Check(model, col, "relationships", parent="stg_customers",
                 parent_column="customer_id")


def _rng(model, col, lo=None, hi=None, strictly=False):
    return Check(model, col, "between", min_value=lo, max_value=hi, strictly=strictly)


STAGING_CHECKS: List[Check] = [
    Check("stg_customers", "customer_id", "unique"),
    *_nn("stg_customers", "customer_id", "customer_name", "country", "segment",
         "plan_type", "mrr"),
    _av("stg_customers", "country", COUNTRIES),
    _av("stg_customers", "segment", SEGMENTS),
    _av("stg_customers", "plan_type", PLANS),
    _rng("stg_customers", "mrr", lo=0, strictly=True),

    Check("stg_subscriptions", "subscription_id", "unique"),
    *_nn("stg_subscriptions", "subscription_id", "customer_id", "plan_type", "mrr",
         "is_active", "is_churned"),
    _rel("stg_subscriptions", "customer_id"),
    _av("stg_subscriptions", "plan_type", PLANS),
    _av("stg_subscriptions", "churn_reason", CHURN_REASONS, where="churn_reason is not null"),

    Check("stg_leads", "lead_id", "unique"),
    *_nn("stg_leads", "lead_id", "customer_id", "country", "is_converted"),
    _av("stg_leads", "country", COUNTRIES),
    _av("stg_leads", "lead_status", LEAD_STATUSES),

    Check("stg_invoices", "invoice_id", "unique"),
    *_nn("stg_invoices", "invoice_id", "customer_id", "amount"),
    _rel("stg_invoices", "customer_id"),
    _rng("stg_invoices", "amount", lo=0, strictly=True),
    _av("stg_invoices", "status", INVOICE_STATUSES),

    Check("stg_partners", "partner_id", "unique"),
    *_nn("stg_partners", "partner_id", "commission_rate"),
    _rng("stg_partners", "commission_rate", lo=0, hi=1),
    _av("stg_partners", "status", PARTNER_STATUSES),

    Check("stg_nps_surveys", "survey_id", "unique"),
    *_nn("stg_nps_surveys", "survey_id", "customer_id", "nps_score", "csat_score"),
    _rng("stg_nps_surveys", "nps_score", lo=0, hi=10),
    _rng("stg_nps_surveys", "csat_score", lo=1, hi=5),
    _av("stg_nps_surveys", "nps_category", NPS_CATEGORIES),

    Check("stg_upsell_events", "upsell_id", "unique"),
    *_nn("stg_upsell_events", "upsell_id", "customer_id", "incremental_revenue"),
    _rel("stg_upsell_events", "customer_id"),
    _av("stg_upsell_events", "upsell_type", UPSELL_TYPES),
    _rng("stg_upsell_events", "incremental_revenue", lo=0),
]

MART_CHECKS: List[Check] = [
    *_nn("mart_supply_demand", "country", "month"),
    _rng("mart_supply_demand", "conversion_rate_pct", lo=0, hi=100),
    *_nn("mart_churn", "record_type"),
    _av("mart_churn", "record_type", RECORD_TYPES["mart_churn"]),
    *_nn("mart_upselling", "record_type"),
    _av("mart_upselling", "record_type", RECORD_TYPES["mart_upselling"]),
    Check("mart_roi_partnerships", "partner_id", "unique"),
    *_nn("mart_roi_partnerships", "partner_id"),
    *_nn("mart_debt_collection", "record_type"),
    _av("mart_debt_collection", "record_type", RECORD_TYPES["mart_debt_collection"]),
    *_nn("mart_customer_satisfaction", "record_type"),
    _av("mart_customer_satisfaction", "record_type",
        RECORD_TYPES["mart_customer_satisfaction"]),
]

ALL_CHECKS: List[Check] = STAGING_CHECKS + MART_CHECKS

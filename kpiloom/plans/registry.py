"""Named queries: each callable takes ``(spark, sf_dir)`` and returns a DataFrame.

Sources are derived from the driver tables under ``sf_dir`` (see
:mod:`kpiloom.sources.driver_tables`); every query runs over the whole tables
and pins ``as_of`` to :data:`kpiloom.config.DEFAULT_AS_OF`.
"""

from __future__ import annotations

import uuid
from typing import Callable, Dict, Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.config import DEFAULT_AS_OF, DEFAULT_CONFIG
from kpiloom.functions import kpi
from kpiloom.functions.spine import month_spine
from kpiloom.operators import (
    churn, debt, partners, quality, satisfaction, staging, supply_demand, upselling,
)
from kpiloom.operators.joins import DEFAULT_HOT_ROWS
from kpiloom.plans.marts import (
    MART_NAMES, STAGING_NAMES, build_mart, find_hot_customers, present_numbered, refresh_months, register_models,
)
from kpiloom.session import shared_dir
from kpiloom.sources.driver_tables import load_skewed_sources, load_sources, write_dirty_invoices
from kpiloom.sources.io import read_source, write_source
from kpiloom.sources.published import publish, read_published
from kpiloom.sources.rejects import land_source, reject_counts

Query = Callable[[SparkSession, str], DataFrame]

CFG, AS_OF = DEFAULT_CONFIG, DEFAULT_AS_OF


def staged(spark: SparkSession, sf_dir: str) -> Dict[str, DataFrame]:
    """Staged frames for ``sf_dir``; the (lazy, immutable) plans are built once
    per session, which holds them, and shared by every query."""
    plans = spark.__dict__.setdefault("_kpiloom_staged", {})
    if sf_dir not in plans:
        plans[sf_dir] = staging.stage_all(load_sources(spark, sf_dir), CFG, AS_OF)
    return plans[sf_dir]


def hot_customers(spark: SparkSession, st: Dict[str, DataFrame],
                  hot_rows: int = DEFAULT_HOT_ROWS) -> Optional[DataFrame]:
    """The customers whose joins are split, found once for a set of staged frames (a job)."""
    if "hot" not in st or st["hot"][0] != hot_rows:
        path = f"{shared_dir(spark)}/hot-customers-{uuid.uuid4().hex}"
        st["hot"] = hot_rows, find_hot_customers(st, path, hot_rows)
    return st["hot"][1]


def _stage_query(model: str) -> Query:
    return lambda spark, sf: staged(spark, sf)[STAGING_NAMES[model]]


# marts and operators with many-to-many joins find their hot customers first
FANOUT_QUERIES = ("at_risk_customers", "enriched_surveys", "detractor_detail",
                  "mart_churn", "mart_customer_satisfaction")


def _mart_query(name: str) -> Query:
    def run(spark, sf):
        st = staged(spark, sf)
        hot = hot_customers(spark, st) if name in FANOUT_QUERIES else None
        return build_mart(name, st, CFG, AS_OF, hot)
    return run


def _fanout(fn, make: Callable = staged, hot_rows: int = DEFAULT_HOT_ROWS) -> Query:
    def run(spark, sf):
        st = make(spark, sf)
        return fn(st, hot_customers(spark, st, hot_rows), hot_rows)
    return run


def at_risk(st, hot, hot_rows):
    return churn.at_risk_customers(st["cust"], st["subs"], st["surv"], st["inv"], CFG, AS_OF, hot, hot_rows)


def enriched(st, hot, hot_rows):
    return satisfaction.enriched_surveys(st["surv"], st["cust"], st["subs"], hot, hot_rows)


def detractors(st, hot, hot_rows):
    return satisfaction.detractor_detail(st["surv"], st["cust"], st["subs"], hot, hot_rows)


# rows of a customer and side above which the skewed queries split it
SKEWED_HOT_ROWS = 8


def skewed(spark: SparkSession, sf_dir: str) -> Dict[str, DataFrame]:
    """Staged frames in which one customer has far more rows than any other."""
    return staging.stage_all(load_skewed_sources(spark, sf_dir), CFG, AS_OF)


def q_skewed_mart_churn(st, hot, hot_rows):
    return build_mart("mart_churn", st, CFG, AS_OF, hot, hot_rows)


def q_skewed_mart_satisfaction(st, hot, hot_rows):
    return build_mart("mart_customer_satisfaction", st, CFG, AS_OF, hot, hot_rows)


# -- presentation order --------------------------------------------------------

def _presented(name: str) -> Query:
    return lambda spark, sf: present_numbered(_mart_query(name)(spark, sf), name)


# -- sinks ---------------------------------------------------------------------

def _sink_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def q_sink_mart(spark, sf):
    """The debt mart published, published again, and read back."""
    path, mart = _sink_dir(spark, "sink"), _mart_query("mart_debt_collection")(spark, sf)
    publish(mart.filter("record_type = 'aging_breakdown'"), path)
    publish(mart, path)
    return read_published(spark, path)


def q_sink_mart_month(spark, sf):
    """The churn mart by month: published a month short, that month refreshed, and the
    rows from then on read back."""
    path, mart = _sink_dir(spark, "sink-month"), _mart_query("mart_churn")(spark, sf)
    month = AS_OF.replace(day=1)
    publish(mart.filter(F.col("month").isNull() | (F.col("month") != month)), path, "month")
    refresh_months(mart, path, [month])
    return read_published(spark, path).filter(F.col("month") >= F.lit(month.replace(year=month.year - 1)))


# -- views ---------------------------------------------------------------------

# one statement a mart, over the views of the models
VIEW_SQL = {
    "sql_supply_demand": """
        SELECT country, sum(total_leads) AS leads, sum(converted_leads) AS converted
        FROM mart_supply_demand GROUP BY country""",
    "sql_churn": """
        SELECT c.segment, r.churn_risk_level, count(*) AS at_risk_rows, count(DISTINCT r.customer_id) AS customers
        FROM mart_churn r JOIN stg_customers c ON c.customer_id = r.customer_id
        WHERE r.record_type = 'at_risk_customer' GROUP BY c.segment, r.churn_risk_level""",
    "sql_upselling": """
        SELECT record_type, count(*) AS n, count(DISTINCT country) AS countries FROM mart_upselling GROUP BY record_type""",
    "sql_roi_partnerships": """
        SELECT p.country, p.status, count(*) AS partners, count_if(r.roi_pct > 0) AS gaining
        FROM mart_roi_partnerships r JOIN stg_partners p ON p.partner_id = r.partner_id GROUP BY p.country, p.status""",
    "sql_debt_collection": """
        SELECT record_type, country, count(*) AS n FROM mart_debt_collection GROUP BY record_type, country""",
    "sql_customer_satisfaction": """
        SELECT country, sum(survey_responses) AS responses, sum(detractors) AS detractors
        FROM mart_customer_satisfaction WHERE record_type = 'nps_monthly' GROUP BY country""",
}


def _over_views(statement: str) -> Query:
    def run(spark, sf):
        st = staged(spark, sf)
        frames = {model: st[key] for model, key in STAGING_NAMES.items() if model in statement}
        frames.update({name: _mart_query(name)(spark, sf) for name in MART_NAMES if name in statement})
        register_models(frames)
        return spark.sql(statement)
    return run


def _part(fn) -> Query:
    return lambda spark, sf: fn(staged(spark, sf))


# -- macro applications over the staged tables ------------------------------

def q_safe_divide(st):
    return st["inv"].select("invoice_id", "amount", "days_overdue",
                            kpi.safe_divide("amount", "days_overdue")
                            .alias("amount_per_overdue_day"))


def q_pct(st):
    return (st["inv"].groupBy("country", "currency")
            .agg(F.count(F.lit(1)).alias("invoices"),
                 F.count_if(F.col("is_currently_overdue")).alias("overdue"))
            .withColumn("overdue_pct", kpi.pct("overdue", "invoices", 2)))


def q_nps_score(st):
    cat = F.col("nps_category")
    return (st["surv"].withColumn("month", kpi.month_start("survey_date"))
            .groupBy("country", "month")
            .agg(F.count_if(cat == "promoter").alias("promoters"),
                 F.count_if(cat == "detractor").alias("detractors"),
                 F.count(F.lit(1)).alias("responses"))
            .withColumn("nps", kpi.nps_score("promoters", "detractors", "responses")))


def q_date_spine_months(st):
    bounds = (st["inv"].groupBy("country")
              .agg(F.min("issue_date").alias("start_date"), F.max("due_date").alias("end_date")))
    return month_spine(bounds).select("country", "date_month")


def q_aging_bucket(st):
    return st["inv"].select("invoice_id", "days_overdue",
                            kpi.aging_bucket("days_overdue").alias("aging_bucket"))


def q_classify_nps(st):
    return st["surv"].select("survey_id", "nps_score",
                             kpi.classify_nps("nps_score").alias("nps_category"))


# -- data quality ------------------------------------------------------------

def _dq(kinds) -> Query:
    def run(spark, sf):
        checks = [c for c in quality.ALL_CHECKS if c.kind in kinds]
        st = staged(spark, sf)
        used = {c.model for c in checks} | {c.parent for c in checks if c.parent}
        frames = {model: st[key] for model, key in STAGING_NAMES.items() if model in used}
        frames.update({name: build_mart(name, st, CFG, AS_OF)
                       for name in MART_NAMES if name in used})
        return quality.run_checks(frames, checks)
    return run


# failing rows of each kind of check, on data that fails it
def q_failing_unique(st):
    return quality.unique(st["inv"], "customer_id")


def q_failing_not_null(st):
    return quality.not_null(st["inv"], "customer_id").select("invoice_id", "country", "amount")


def q_failing_accepted_values(spark, sf):
    raw = load_sources(spark, sf)["leads"]  # one status still has its leading blank
    return quality.accepted_values(raw, "lead_status", quality.LEAD_STATUSES[:3])


def q_failing_relationships(st):
    return quality.relationships(st["inv"], "customer_id", st["cust"], "customer_id").select(
        "invoice_id", "customer_id")


def q_failing_between(st):
    return quality.between(st["surv"], "nps_score", 2, 9, strictly=True).select("survey_id", "nps_score")


def _round_trip(name: str, fmt: str) -> Query:
    """A source table written in a format and read back by its reader."""
    def run(spark, sf):
        path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}.{fmt}"
        write_source(load_sources(spark, sf)[name], path, fmt)
        return read_source(spark, path, name, fmt)
    return run


def q_read_source_headers(spark, sf):
    """Leads in files of two header orders, one with a further column, read as one table."""
    path, src = _sink_dir(spark, "headers"), load_sources(spark, sf)["leads"]
    late = F.col("lead_date") >= "2024-01-01"
    write_source(src.filter(~late), f"{path}/a", "csv")
    write_source(src.filter(late).select(*reversed(src.columns), F.lit("x").alias("note")), f"{path}/b", "csv")
    return read_source(spark, f"{path}/*", "leads", "csv")


def _landed(spark, sf):
    path, out = _sink_dir(spark, "dirty"), _sink_dir(spark, "landed")
    write_dirty_invoices(load_sources(spark, sf)["invoices"], path)
    return land_source(spark, path, "invoices", out)


def q_read_source_rejects(spark, sf):
    """Invoices with bad numbers, dates and lines: what was set aside, counted."""
    return reject_counts(_landed(spark, sf)[1])


def q_read_source_accepted(spark, sf):
    """The same invoices: the rows without fault."""
    return _landed(spark, sf)[0]


QUERIES: Dict[str, Query] = {
    # sources, written and read back
    "read_source_csv": _round_trip("leads", "csv"),
    "read_source_parquet": _round_trip("invoices", "parquet"),
    "read_source_customers": _round_trip("customers", "csv"),
    "read_source_subscriptions": _round_trip("subscriptions", "csv"),
    "read_source_partners": _round_trip("partners", "csv"),
    "read_source_nps_surveys": _round_trip("nps_surveys", "csv"),
    "read_source_upsell_events": _round_trip("upsell_events", "csv"),
    "read_source_headers": q_read_source_headers,
    "read_source_rejects": q_read_source_rejects,
    "read_source_accepted": q_read_source_accepted,
    # staging
    **{model: _stage_query(model) for model in STAGING_NAMES},
    # supply & demand
    "lead_metrics": _part(lambda st: supply_demand.lead_metrics(st["leads"], CFG)),
    # churn
    "monthly_churn": _part(lambda st: churn.monthly_churn(st["subs"], AS_OF)),
    "at_risk_customers": _fanout(at_risk),
    # upselling
    "monthly_upsell": _part(lambda st: upselling.monthly_upsell(st["ups"])),
    "eligible_customers": _part(lambda st: upselling.eligible_customers(
        st["cust"], st["subs"], CFG)),
    "upsold_customers": _part(lambda st: upselling.upsold_customers(st["ups"])),
    "attach_rate_by_segment": _part(lambda st: upselling.attach_rate_by_segment(
        st["cust"], st["subs"], st["ups"], CFG)),
    # partner ROI
    "partner_revenue": _part(lambda st: partners.partner_revenue(
        st["cust"], st["subs"], st["part"], AS_OF)),
    "partner_leads": _part(lambda st: partners.partner_leads(st["leads"], st["cust"])),
    # debt collection
    "enriched_invoices": _part(lambda st: debt.enriched_invoices(st["inv"], st["cust"])),
    "debt_summary": _part(lambda st: debt.debt_summary(
        debt.enriched_invoices(st["inv"], st["cust"]))),
    "aging_breakdown": _part(lambda st: debt.aging_breakdown(
        debt.enriched_invoices(st["inv"], st["cust"]))),
    "high_risk_debtors": _part(lambda st: debt.high_risk_debtors(st["inv"], st["cust"])),
    # customer satisfaction
    "enriched_surveys": _fanout(enriched),
    "nps_monthly": _part(lambda st: satisfaction.nps_monthly(
        st["surv"], st["cust"], st["subs"])),
    "detractor_detail": _fanout(detractors),
    "response_rate": _part(lambda st: satisfaction.response_rate(st["cust"], st["surv"])),
    # the six marts
    **{name: _mart_query(name) for name in MART_NAMES},
    # marts and operators over sources with a hot customer, whose joins are split
    "skewed_at_risk_customers": _fanout(at_risk, skewed, SKEWED_HOT_ROWS),
    "skewed_enriched_surveys": _fanout(enriched, skewed, SKEWED_HOT_ROWS),
    "skewed_mart_churn": _fanout(q_skewed_mart_churn, skewed, SKEWED_HOT_ROWS),
    "skewed_mart_customer_satisfaction": _fanout(q_skewed_mart_satisfaction, skewed, SKEWED_HOT_ROWS),
    # the marts in presentation order, with positions
    **{name.replace("mart_", "present_", 1): _presented(name) for name in MART_NAMES},
    # sinks, written and read back
    "sink_mart": q_sink_mart,
    "sink_mart_month": q_sink_mart_month,
    # SQL over the models' views
    **{name: _over_views(statement) for name, statement in VIEW_SQL.items()},
    # macros
    "safe_divide": _part(q_safe_divide),
    "pct": _part(q_pct),
    "nps_score": _part(q_nps_score),
    "date_spine_months": _part(q_date_spine_months),
    "aging_bucket": _part(q_aging_bucket),
    "classify_nps": _part(q_classify_nps),
    # data quality
    "dq_unique": _dq({"unique"}),
    "dq_not_null": _dq({"not_null"}),
    "dq_accepted_values": _dq({"accepted_values"}),
    "dq_relationships": _dq({"relationships"}),
    "dq_between": _dq({"between"}),
    "dq_failing_unique": _part(q_failing_unique),
    "dq_failing_not_null": _part(q_failing_not_null),
    "dq_failing_accepted_values": q_failing_accepted_values,
    "dq_failing_relationships": _part(q_failing_relationships),
    "dq_failing_between": _part(q_failing_between),
    "dq_suite": _dq({"unique", "not_null", "accepted_values", "relationships", "between"}),
}

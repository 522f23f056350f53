"""Staging operators: clean and type one source, derive row-level fields.

Each is a narrow projection (row count preserved, no shuffle).  Cleaning runs
in one ``select`` and derivations read the *cleaned* columns in the next, so a
blank date never counts as present.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.config import DEFAULT_CONFIG, KpiConfig
from kpiloom.functions.kpi import (
    as_of_column, blank_to_null, classify_nps, day_diff, month_diff, region_of, to_date,
)


def stg_customers(src: DataFrame, as_of=None) -> DataFrame:
    today = as_of_column(as_of)
    clean = src.select(
        "customer_id", "customer_name", "country", "segment",
        to_date("signup_date").alias("signup_date"),
        "plan_type", F.col("monthly_revenue").alias("mrr"), "partner_id")
    return clean.select("*", day_diff("signup_date", today).alias("tenure_days"),
                        region_of("country").alias("region"))


def stg_subscriptions(src: DataFrame, as_of=None) -> DataFrame:
    today = as_of_column(as_of)
    churn = F.col("churn_date")
    clean = src.select(
        "subscription_id", "customer_id", "plan_type",
        to_date("start_date").alias("start_date"),
        to_date("end_date").alias("end_date"),
        to_date("churn_date").alias("churn_date"),
        blank_to_null("churn_reason").alias("churn_reason"),
        "mrr", "country")
    return clean.select(
        "*",
        (churn.isNull() & F.col("end_date").isNull()).alias("is_active"),
        churn.isNotNull().alias("is_churned"),
        F.when(churn.isNotNull(), day_diff(churn, today)).alias("days_since_churn"))


def stg_leads(src: DataFrame) -> DataFrame:
    lead, assigned, converted = F.col("lead_date"), F.col("assigned_at"), F.col("converted_at")
    clean = src.select(
        "lead_id", "customer_id", "country", "service_type",
        to_date("lead_date").alias("lead_date"),
        to_date("assigned_at").alias("assigned_at"),
        to_date("converted_at").alias("converted_at"),
        F.trim("lead_status").alias("lead_status"),
        "lead_source")
    return clean.select(
        "*",
        # hours between two dates: whole days × 24
        F.when(assigned.isNotNull(), day_diff(lead, assigned) * 24).alias("hours_to_assign"),
        F.when(converted.isNotNull(), day_diff(lead, converted)).alias("days_to_convert"),
        (F.col("lead_status") == "converted").alias("is_converted"))


def stg_invoices(src: DataFrame, as_of=None) -> DataFrame:
    today = as_of_column(as_of)
    state = F.trim("status")
    clean = src.select(
        "invoice_id", "customer_id",
        to_date("issue_date").alias("issue_date"),
        to_date("due_date").alias("due_date"),
        to_date("paid_date").alias("paid_date"),
        "amount", "currency", "status", "country")
    return clean.select(
        "*",
        F.when(state.isin("overdue", "paid_late"),
               day_diff("due_date", F.coalesce(F.col("paid_date"), today)))
        .otherwise(F.lit(0).cast("long")).alias("days_overdue"),
        (state == "overdue").alias("is_currently_overdue"))


def stg_partners(src: DataFrame, as_of=None) -> DataFrame:
    today = as_of_column(as_of)
    clean = src.select(
        "partner_id", "partner_name", "country", "partner_type",
        to_date("contract_start_date").alias("contract_start_date"),
        "monthly_fee", "commission_rate", "status")
    return clean.select("*", month_diff("contract_start_date", today)
                        .alias("partner_tenure_months"))


def stg_nps_surveys(src: DataFrame, cfg: KpiConfig = DEFAULT_CONFIG) -> DataFrame:
    clean = src.select(
        "survey_id", "customer_id", to_date("survey_date").alias("survey_date"),
        "nps_score", "csat_score", "country", "comment")
    return clean.select(
        "*",
        classify_nps("nps_score", cfg.nps_high_score, cfg.nps_low_score,
                     cfg.nps_passive_score).alias("nps_category"),
        (F.col("csat_score") >= 4).alias("is_satisfied"))


def stg_upsell_events(src: DataFrame) -> DataFrame:
    frm, to, add_on = F.col("from_plan"), F.col("to_plan"), F.col("add_on")
    clean = src.select(
        "upsell_id", "customer_id", to_date("upsell_date").alias("upsell_date"),
        "from_plan", "to_plan", blank_to_null("add_on").alias("add_on"),
        "add_on_revenue", "sales_rep", "country")
    return clean.select(
        "*",
        F.when(frm != to, F.lit("plan_upgrade"))
        .when(add_on.isNotNull(), F.lit("add_on_sale"))
        .otherwise(F.lit("unknown")).alias("upsell_type"),
        F.coalesce(F.col("add_on_revenue"), F.lit(0).cast("long")).alias("incremental_revenue"))


def stage_all(sources: dict, cfg: KpiConfig = DEFAULT_CONFIG, as_of=None) -> dict:
    """Stage every source; keys are the short frame names used by the marts."""
    return {
        "cust": stg_customers(sources["customers"], as_of),
        "subs": stg_subscriptions(sources["subscriptions"], as_of),
        "leads": stg_leads(sources["leads"]),
        "inv": stg_invoices(sources["invoices"], as_of),
        "part": stg_partners(sources["partners"], as_of),
        "surv": stg_nps_surveys(sources["nps_surveys"], cfg),
        "ups": stg_upsell_events(sources["upsell_events"]),
    }

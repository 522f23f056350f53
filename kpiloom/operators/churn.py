"""Churn: monthly churn summary and per-customer churn-risk scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.config import DEFAULT_CONFIG, KpiConfig
from kpiloom.functions.kpi import (
    as_of_column, day_diff, month_start, round_ratio_sql, sql_exprs,
)
from kpiloom.operators.joins import DEFAULT_HOT_ROWS, fanout_join, hot_keys
from kpiloom.operators.union import conform, union_records


def monthly_churn(subs: DataFrame, as_of=None) -> DataFrame:
    """Group by churn month (as-of month for live rows), country, plan, reason."""
    today = as_of_column(as_of)
    total, churned = "count(1)", "count_if(is_churned)"
    tenure = "CASE WHEN is_churned THEN datediff(churn_date, start_date) END"
    return (subs
            .groupBy(month_start(F.coalesce(F.col("churn_date"), today)).alias("month"),
                     "country", "plan_type", "churn_reason")
            .agg(*sql_exprs(
                f"{total} AS total_subscriptions",
                f"{churned} AS churned_count",
                "count_if(is_active) AS active_count",
                "sum(IF(is_churned, mrr, 0)) AS churned_mrr",
                "sum(IF(is_active, mrr, 0)) AS active_mrr",
                f"{round_ratio_sql(churned, total, 2, 100)} AS churn_rate_pct",
                f"{round_ratio_sql(f'sum({tenure})', f'count({tenure})', 0)} "
                "AS avg_days_to_churn")))


def _risk_score_sql(cfg: KpiConfig) -> str:
    # Score points per risk signal.
    return ("CAST(IF(nps_category = 'detractor', 3, 0) + IF(nps_category = 'passive', 1, 0)"
            " + IF(is_currently_overdue, 2, 0)"
            f" + IF(subscription_tenure_days < {cfg.upsell_min_tenure_days}, 1, 0) AS BIGINT)")


def at_risk_customers(cust: DataFrame, subs: DataFrame, surv: DataFrame, inv: DataFrame,
                      cfg: KpiConfig = DEFAULT_CONFIG, as_of=None, hot: DataFrame = None,
                      hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Customers with an active subscription, every survey and overdue invoice.

    Grain: customer × active subscription × survey × currently overdue invoice
    (left joins, no de-duplication).  ``hot`` names the customers whose product is
    split over many tasks, with their counts ``n_active``, ``n_surveys`` and
    ``n_overdue`` (:func:`kpiloom.plans.marts.find_hot_customers`); without it the
    joins stay plain and co-partitioned.
    """
    today = as_of_column(as_of)
    key = "customer_id"
    active = subs.filter(F.col("is_active")).select(key, "start_date")
    base = (cust.select(key, "customer_name", "country", "segment", "plan_type", "mrr")
            .join(active, key, "inner")
            .withColumn("subscription_tenure_days", day_diff("start_date", today)))
    surveys = surv.select(key, "nps_score", "nps_category",
                          F.col("survey_date").alias("last_survey_date"))
    overdue = (inv.filter(F.col("is_currently_overdue"))
               .select(key, "is_currently_overdue", "days_overdue"))
    # subscriptions meet surveys, and their product meets overdue invoices
    grids = (None, None) if hot is None else (
        hot_keys(hot, key, "n_active", "n_surveys", hot_rows),
        hot_keys(hot, key, "n_active * greatest(n_surveys, 1)", "n_overdue", hot_rows))
    joined = fanout_join(base, surveys, key, "left", grids[0], hot_rows)
    joined = fanout_join(joined, overdue, key, "left", grids[1], hot_rows)
    return (joined
            .selectExpr("customer_id", "customer_name", "country", "segment", "plan_type",
                        "mrr", "start_date", "subscription_tenure_days", "nps_score",
                        "nps_category", "last_survey_date", "is_currently_overdue",
                        "days_overdue", f"{_risk_score_sql(cfg)} AS risk_score")
            .selectExpr("*", "CASE WHEN risk_score >= 4 THEN 'high' "
                        "WHEN risk_score >= 2 THEN 'medium' ELSE 'low' END AS churn_risk_level"))


MART_CHURN_COLUMNS = [
    ("record_type", "string"), ("month", "date"), ("country", "string"),
    ("plan_type", "string"), ("churn_reason", "string"), ("total_subscriptions", "bigint"),
    ("churned_count", "bigint"), ("active_count", "bigint"), ("churned_mrr", "bigint"),
    ("active_mrr", "bigint"), ("churn_rate_pct", "double"), ("avg_days_to_churn", "double"),
    ("customer_id", "string"), ("customer_name", "string"), ("segment", "string"),
    ("mrr", "bigint"), ("nps_score", "bigint"), ("nps_category", "string"),
    ("is_currently_overdue", "boolean"), ("days_overdue", "bigint"),
    ("risk_score", "bigint"), ("churn_risk_level", "string"),
]


def mart_churn(cust: DataFrame, subs: DataFrame, surv: DataFrame, inv: DataFrame,
               cfg: KpiConfig = DEFAULT_CONFIG, as_of=None, hot: DataFrame = None,
               hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    monthly = conform(monthly_churn(subs, as_of), MART_CHURN_COLUMNS,
                      record_type="'monthly_churn_summary'")
    risk = at_risk_customers(cust, subs, surv, inv, cfg, as_of, hot, hot_rows)
    risk = conform(risk, MART_CHURN_COLUMNS,
                   record_type="'at_risk_customer'", active_mrr="mrr")
    return union_records([monthly, risk])


# (column, direction, nulls); an unqualified ascending key sorts nulls high.
CHURN_ORDER = [("record_type", "asc", "last"), ("month", "desc", "last"),
               ("churn_risk_level", "asc", "last")]

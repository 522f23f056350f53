"""Partner ROI: revenue, cost, ROI, payback and acquisition cost per partner.

Partners are a dimension: the customer × subscription rows are aggregated per
``partner_id`` first and only the per-partner results meet the partner table,
so a partner holding a third of all customers never becomes one hot join
partition (the aggregation combines map-side).  Duplicate partner rows, if
any, multiply counts and sums exactly as the row-level join would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.kpi import as_of_column, month_diff, round_ratio_sql, sql_exprs

_RATE = "DECIMAL(18,15)"  # as many places as a double below 1 holds
_MONEY = "DECIMAL(18,0)"


def _partner_dim(part: DataFrame) -> DataFrame:
    """One row per partner id: copies in the table and the (max) commission rate."""
    return (part.groupBy("partner_id")
            .agg(*sql_exprs("count(1) AS _copies", "max(commission_rate) AS _rate")))


def partner_revenue(cust: DataFrame, subs: DataFrame, part: DataFrame,
                    as_of=None) -> DataFrame:
    today = as_of_column(as_of)
    active_mrr = "IF(is_active, mrr, 0)"
    # subscriptions are summed per customer before they meet the customers, so a
    # customer with very many of them is one row of the join
    months = month_diff("start_date", F.coalesce(F.col("end_date"), today))
    per_customer = (subs.filter("customer_id IS NOT NULL")
                    .select("customer_id", "is_active", "is_churned", "mrr", months.alias("_m"))
                    .groupBy("customer_id")
                    .agg(*sql_exprs(
                        "count_if(is_active) AS _active",
                        "count_if(is_churned) AS _churned",
                        f"sum({active_mrr}) AS _active_mrr",
                        f"count({active_mrr}) AS _active_n",
                        "sum(mrr) AS _mrr",
                        "sum(_m) AS _months",
                        "count(_m) AS _months_n")))
    sums = ("_active", "_churned", "_active_mrr", "_active_n", "_mrr", "_months", "_months_n")
    per_partner = (cust.filter("partner_id IS NOT NULL")
                   .select("customer_id", "partner_id")
                   .join(per_customer, "customer_id", "inner")
                   .groupBy("partner_id")
                   .agg(*sql_exprs("count(DISTINCT customer_id) AS total_customers",
                                   *[f"sum({c}) AS {c}" for c in sums])))
    # avg(active mrr) × avg(months) = (S1·S2)/(n1·n2); copies of a partner cancel
    ltv = round_ratio_sql("CAST(_active_mrr AS DECIMAL(38,0)) * _months",
                          "_active_n * _months_n", 2)
    return (per_partner.join(_partner_dim(part), "partner_id", "inner")
            .selectExpr(
                "partner_id", "total_customers",
                "_active * _copies AS active_customers",
                "_churned * _copies AS churned_customers",
                "_active_mrr * _copies AS active_mrr",
                "_mrr * _copies AS total_mrr_ever",
                f"{ltv} AS estimated_avg_ltv",
                # round(active MRR × rate, 2) in exact decimals
                f"CAST(round(CAST(_active_mrr * _copies AS {_MONEY}) * CAST(_rate AS {_RATE}), 2)"
                " AS DOUBLE) AS monthly_commission_owed"))


def partner_leads(leads: DataFrame, cust: DataFrame) -> DataFrame:
    """Partner-channel leads per referring partner (null partner is a group)."""
    total, converted = "count(1)", "count_if(is_converted)"
    return (leads.filter("lead_source = 'partner'")
            .select("customer_id", "is_converted")
            .join(cust.select("customer_id", "partner_id"), "customer_id", "inner")
            .groupBy("partner_id")
            .agg(*sql_exprs(
                f"{total} AS partner_leads",
                f"{converted} AS partner_lead_conversions",
                f"{round_ratio_sql(converted, total, 2, 100)} AS partner_conversion_rate_pct")))


def mart_roi_partnerships(part: DataFrame, cust: DataFrame, subs: DataFrame,
                          leads: DataFrame, as_of=None) -> DataFrame:
    rev = partner_revenue(cust, subs, part, as_of)
    lead = partner_leads(leads, cust)
    # cents, exact: the commission is already rounded to 2 places
    commission_cents = ("COALESCE(CAST(CAST(monthly_commission_owed AS DECIMAL(22,2)) * 100 "
                        "AS DECIMAL(38,0)), CAST(0 AS DECIMAL(38,0)))")
    cost_cents = f"(CAST(monthly_fee AS DECIMAL(38,0)) * 100 + {commission_cents})"
    net_cents = f"(CAST(COALESCE(active_mrr, 0) AS DECIMAL(38,0)) * 100 - {cost_cents})"
    fees_to_date = "monthly_fee * partner_tenure_months"
    return (part.join(rev, "partner_id", "left").join(lead, "partner_id", "left")
            .selectExpr(
                "partner_id", "partner_name", "country", "partner_type",
                "contract_start_date", "monthly_fee", "commission_rate",
                "partner_tenure_months",
                "COALESCE(total_customers, 0L) AS total_customers",
                "COALESCE(active_customers, 0L) AS active_customers",
                "COALESCE(churned_customers, 0L) AS churned_customers",
                "COALESCE(active_mrr, 0L) AS active_mrr",
                "COALESCE(total_mrr_ever, 0L) AS total_mrr_ever",
                "COALESCE(estimated_avg_ltv, 0D) AS estimated_avg_ltv",
                "COALESCE(monthly_commission_owed, 0D) AS monthly_commission_owed",
                "COALESCE(partner_leads, 0L) AS partner_leads",
                "COALESCE(partner_lead_conversions, 0L) AS partner_lead_conversions",
                "COALESCE(partner_conversion_rate_pct, 0D) AS partner_conversion_rate_pct",
                f"CAST({cost_cents} AS DOUBLE) / 100 AS total_monthly_cost",
                f"CAST({net_cents} AS DOUBLE) / 100 AS net_monthly_value",
                f"{round_ratio_sql(net_cents, cost_cents, 2, 100)} AS roi_pct",
                f"{round_ratio_sql(fees_to_date, 'COALESCE(active_mrr, 0L)', 1)} "
                "AS payback_period_months",
                f"{round_ratio_sql(fees_to_date, 'COALESCE(total_customers, 0L)', 2)} "
                "AS cost_per_acquired_customer"))


# Descending with nulls high: partners without a cost come first.
ROI_ORDER = [("roi_pct", "desc", "first")]

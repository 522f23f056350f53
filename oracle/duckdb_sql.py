"""Independent DuckDB formulations of every registered query (the test oracle).

Written directly in DuckDB's SQL dialect over the pre-registered driver views
(``customer``, ``supplier``, ``orders``, ``events``).  Each query is one
statement: a chain of CTEs for the seven source shapes, their staging, and the
mart logic, followed by the final ``SELECT``.  Ratios are rounded half away
from zero on exact integers (HUGEINT), which is what the Spark side does with
decimals, so both engines produce identical doubles.  Conditional counts are
written ``count(CASE WHEN c THEN 1 END)``: DuckDB's ``count_if`` returns NULL
rather than 0 when every input is NULL.
"""

from __future__ import annotations

AS_OF = "DATE '2024-04-01'"


def R(num: str, den: str, k: int, m: int = 1) -> str:
    """round(num * m / den, k), half away from zero, exactly; NULL on 0/NULL."""
    n = f"(CAST(({num}) AS HUGEINT) * {m * 10 ** k})"
    d = f"CAST(({den}) AS HUGEINT)"
    return (f"(CASE WHEN {d} = 0 THEN NULL ELSE CAST(sign({n}) * sign({d}) * "
            f"((2 * abs({n}) + abs({d})) // (2 * abs({d}))) AS DOUBLE) / {10 ** k} END)")


def B(expr: str) -> str:
    return f"CAST(({expr}) AS BIGINT)"


def _market(key: str) -> str:
    return (f"CASE ({key}) % 6 WHEN 0 THEN 'DK' WHEN 1 THEN 'NO' WHEN 2 THEN 'SE' "
            f"WHEN 3 THEN 'DE' WHEN 4 THEN 'NL' ELSE 'US' END")


def _d(base: str, off: str) -> str:
    return f"CAST({base} + CAST(({off}) AS INTEGER) AS VARCHAR)"


# --------------------------------------------------------------------------
# sources
# --------------------------------------------------------------------------

CTES: dict = {}

CTES["src_customers"] = f"""
SELECT 'C' || CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name,
       {_market('c_custkey')} AS country,
       CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'SMB'
            WHEN c_mktsegment IN ('FURNITURE', 'MACHINERY') THEN 'MID' ELSE 'ENT' END AS segment,
       {_d("DATE '2019-01-01'", 'c_custkey * 37 % 1910')} AS signup_date,
       CASE WHEN c_acctbal < 3000 THEN 'basic' WHEN c_acctbal < 7000 THEN 'premium'
            ELSE 'enterprise' END AS plan_type,
       CAST(500 + (c_custkey % 97) * 60 AS BIGINT) AS monthly_revenue,
       CASE WHEN c_custkey % 5 = 0 THEN NULL
            WHEN c_custkey % 3 = 0 THEN 'P' || CAST(c_custkey % 1009 AS VARCHAR)
            ELSE 'P' || CAST(c_custkey % 113 AS VARCHAR) END AS partner_id
FROM customer"""

CTES["src_subscriptions"] = f"""
SELECT 'S' || CAST(o_orderkey AS VARCHAR) AS subscription_id,
       'C' || CAST(o_custkey AS VARCHAR) AS customer_id,
       CASE o_orderkey % 7 % 3 WHEN 0 THEN 'basic' WHEN 1 THEN 'premium' ELSE 'enterprise' END
           AS plan_type,
       {_d("DATE '2019-06-01'", 'o_orderkey * 13 % 1750')} AS start_date,
       CASE WHEN o_orderstatus = 'F' OR (o_orderstatus = 'P' AND o_orderkey % 4 = 1)
            THEN {_d("DATE '2019-06-01'", 'o_orderkey * 13 % 1750 + 60 + o_orderkey % 200')}
            ELSE '' END AS end_date,
       CASE WHEN o_orderstatus = 'F'
            THEN {_d("DATE '2019-06-01'", 'o_orderkey * 13 % 1750 + 60 + o_orderkey % 200')}
            ELSE '' END AS churn_date,
       CASE WHEN o_orderstatus = 'F' THEN
            CASE o_orderkey % 3 WHEN 0 THEN 'price_too_high' WHEN 1 THEN 'competitor'
                 ELSE 'not_using' END
            ELSE ' ' END AS churn_reason,
       CAST(500 + (o_orderkey % 41) * 50 AS BIGINT) AS mrr,
       {_market('o_custkey')} AS country
FROM orders"""

_EV = """SELECT *, CAST(ts AS DATE) AS d0, event_id % 5 % 3 * 30 AS sh,
       event_id * 31 % 100 AS q FROM events"""

CTES["src_leads"] = f"""
SELECT 'L' || CAST(event_id AS VARCHAR) AS lead_id,
       CASE WHEN event_id % 61 <> 0 THEN 'C' || CAST(user_id * 10 + event_id % 10 AS VARCHAR) END
           AS customer_id,
       {_market('user_id * 10 + event_id % 10')} AS country,
       CASE event_id % 11 % 4 WHEN 0 THEN 'accounting' WHEN 1 THEN 'tax_advisory'
            WHEN 2 THEN 'bookkeeping' ELSE 'audit' END AS service_type,
       {_d('d0', 'sh')} AS lead_date,
       CASE WHEN q BETWEEN 70 AND 79 THEN '' ELSE {_d('d0', 'sh + event_id % 13 % 4')} END
           AS assigned_at,
       CASE WHEN q < 50 THEN {_d('d0', 'sh + 5 + event_id % 7')} ELSE '' END AS converted_at,
       CASE WHEN q < 50 THEN 'converted' WHEN q < 70 THEN 'pending'
            WHEN q < 80 THEN ' unassigned' ELSE 'lost' END AS lead_status,
       CASE event_id % 17 % 3 WHEN 0 THEN 'organic' WHEN 1 THEN 'paid' ELSE 'partner' END
           AS lead_source
FROM ({_EV}) e WHERE event_type IN ('click', 'error', 'signup')"""

CTES["src_invoices"] = f"""
SELECT 'INV' || CAST(o_orderkey AS VARCHAR) AS invoice_id,
       CASE WHEN o_orderkey % 53 = 0 THEN NULL
            WHEN o_orderkey % 59 = 0 THEN 'C' || CAST(o_custkey + 900000000 AS VARCHAR)
            ELSE 'C' || CAST(o_custkey AS VARCHAR) END AS customer_id,
       {_d("DATE '2023-06-01'", 'o_orderkey % 300')} AS issue_date,
       {_d("DATE '2023-06-01'", 'o_orderkey % 300 + 30')} AS due_date,
       CASE o_orderstatus
            WHEN 'F' THEN {_d("DATE '2023-06-01'", 'o_orderkey % 300 + 30 - o_orderkey % 10')}
            WHEN 'P' THEN {_d("DATE '2023-06-01'", 'o_orderkey % 300 + 31 + o_orderkey % 40')}
            ELSE '' END AS paid_date,
       CAST(floor(o_totalprice) AS BIGINT) AS amount,
       CASE o_custkey % 6 WHEN 0 THEN 'DKK' WHEN 1 THEN 'NOK' WHEN 2 THEN 'SEK'
            WHEN 5 THEN 'USD' ELSE 'EUR' END AS currency,
       CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'P' THEN 'paid_late'
            WHEN 'O' THEN 'overdue' END AS status,
       {_market('o_custkey')} AS country
FROM orders"""

CTES["src_partners"] = f"""
SELECT 'P' || CAST(s_suppkey AS VARCHAR) AS partner_id, s_name AS partner_name,
       {_market('s_suppkey')} AS country, 'accounting_firm' AS partner_type,
       {_d("DATE '2017-01-01'", 's_suppkey * 29 % 2500')} AS contract_start_date,
       CAST(10000 + (s_suppkey % 13) * 1000 AS BIGINT) AS monthly_fee,
       CAST(500000 + s_suppkey % 10 * 100000 + s_suppkey % 7 AS DOUBLE) / 10000000
           AS commission_rate,
       CASE WHEN s_suppkey % 9 = 8 THEN 'inactive' ELSE 'active' END AS status
FROM supplier"""

CTES["src_nps_surveys"] = f"""
SELECT 'SV' || CAST(event_id AS VARCHAR) AS survey_id,
       CASE WHEN event_id % 67 <> 0 THEN 'C' || CAST(user_id * 10 + event_id % 7 AS VARCHAR) END
           AS customer_id,
       {_d('d0', 'sh')} AS survey_date,
       CAST(event_id % 11 AS BIGINT) AS nps_score, CAST(1 + event_id % 5 AS BIGINT) AS csat_score,
       {_market('user_id * 10 + event_id % 7')} AS country,
       'comment ' || CAST(event_id AS VARCHAR) AS comment
FROM ({_EV}) e WHERE event_type = 'view'"""

CTES["src_upsell_events"] = f"""
SELECT 'U' || CAST(event_id AS VARCHAR) AS upsell_id,
       'C' || CAST(user_id * 10 + event_id % 10 AS VARCHAR) AS customer_id,
       {_d('d0', 'sh')} AS upsell_date,
       CASE WHEN event_id % 3 = 0 THEN 'basic' ELSE 'premium' END AS from_plan,
       CASE WHEN event_id % 4 = 3 THEN 'enterprise' ELSE 'premium' END AS to_plan,
       CASE WHEN event_id % 7 < 4 THEN 'tax_advisory_add_on' ELSE ' ' END AS add_on,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(300 + (event_id % 23) * 50 AS BIGINT) END
           AS add_on_revenue,
       'SR0' || CAST(1 + event_id % 4 AS VARCHAR) AS sales_rep,
       {_market('user_id * 10 + event_id % 10')} AS country
FROM ({_EV}) e WHERE event_type = 'purchase'"""


# --------------------------------------------------------------------------
# staging
# --------------------------------------------------------------------------

def _dt(col: str) -> str:
    return f"CAST(NULLIF(TRIM({col}), '') AS DATE)"


CTES["stg_customers"] = f"""
SELECT *, date_diff('day', signup_date, {AS_OF}) AS tenure_days,
       CASE WHEN country IN ('DK', 'NO', 'SE') THEN 'Scandinavia' WHEN country = 'DE' THEN 'DACH'
            WHEN country = 'NL' THEN 'Benelux' WHEN country = 'US' THEN 'North America' END
           AS region
FROM (SELECT customer_id, customer_name, country, segment, {_dt('signup_date')} AS signup_date,
             plan_type, monthly_revenue AS mrr, partner_id FROM src_customers) t"""

CTES["stg_subscriptions"] = f"""
SELECT *, (churn_date IS NULL AND end_date IS NULL) AS is_active,
       (churn_date IS NOT NULL) AS is_churned,
       CASE WHEN churn_date IS NOT NULL THEN date_diff('day', churn_date, {AS_OF}) END
           AS days_since_churn
FROM (SELECT subscription_id, customer_id, plan_type, {_dt('start_date')} AS start_date,
             {_dt('end_date')} AS end_date, {_dt('churn_date')} AS churn_date,
             NULLIF(TRIM(churn_reason), '') AS churn_reason, mrr, country
      FROM src_subscriptions) t"""

CTES["stg_leads"] = f"""
SELECT *,
       CASE WHEN assigned_at IS NOT NULL THEN date_diff('hour', lead_date, assigned_at) END
           AS hours_to_assign,
       CASE WHEN converted_at IS NOT NULL THEN date_diff('day', lead_date, converted_at) END
           AS days_to_convert,
       (lead_status = 'converted') AS is_converted
FROM (SELECT lead_id, customer_id, country, service_type, {_dt('lead_date')} AS lead_date,
             {_dt('assigned_at')} AS assigned_at, {_dt('converted_at')} AS converted_at,
             TRIM(lead_status) AS lead_status, lead_source FROM src_leads) t"""

CTES["stg_invoices"] = f"""
SELECT *,
       CASE WHEN TRIM(status) IN ('overdue', 'paid_late')
            THEN date_diff('day', due_date, COALESCE(paid_date, {AS_OF})) ELSE 0 END
           AS days_overdue,
       (TRIM(status) = 'overdue') AS is_currently_overdue
FROM (SELECT invoice_id, customer_id, {_dt('issue_date')} AS issue_date,
             {_dt('due_date')} AS due_date, {_dt('paid_date')} AS paid_date, amount, currency,
             status, country FROM src_invoices) t"""

CTES["stg_partners"] = f"""
SELECT *, date_diff('month', contract_start_date, {AS_OF}) AS partner_tenure_months
FROM (SELECT partner_id, partner_name, country, partner_type,
             {_dt('contract_start_date')} AS contract_start_date, monthly_fee, commission_rate,
             status FROM src_partners) t"""

CTES["stg_nps_surveys"] = f"""
SELECT *,
       CASE WHEN nps_score >= 9 THEN 'promoter' WHEN nps_score >= 7 THEN 'passive'
            WHEN nps_score <= 6 THEN 'detractor' END AS nps_category,
       (csat_score >= 4) AS is_satisfied
FROM (SELECT survey_id, customer_id, {_dt('survey_date')} AS survey_date, nps_score, csat_score,
             country, comment FROM src_nps_surveys) t"""

CTES["stg_upsell_events"] = f"""
SELECT *,
       CASE WHEN from_plan != to_plan THEN 'plan_upgrade'
            WHEN add_on IS NOT NULL THEN 'add_on_sale' ELSE 'unknown' END AS upsell_type,
       COALESCE(add_on_revenue, 0) AS incremental_revenue
FROM (SELECT upsell_id, customer_id, {_dt('upsell_date')} AS upsell_date, from_plan, to_plan,
             NULLIF(TRIM(add_on), '') AS add_on, add_on_revenue, sales_rep, country
      FROM src_upsell_events) t"""


# --------------------------------------------------------------------------
# multi-grain marts: one typed column list per mart, branches fill a subset
# --------------------------------------------------------------------------

def _union(contract: list, branches: list) -> str:
    """UNION ALL of branches ``(record_type, from_sql, {column: expression})``."""
    selects = []
    for record_type, source, exprs in branches:
        cols = [f"'{record_type}' AS record_type"]
        for name, dtype in contract[1:]:
            cols.append(f"CAST({exprs.get(name, 'NULL')} AS {dtype}) AS {name}")
        selects.append(f"SELECT {', '.join(cols)} FROM {source}")
    return "\n" + "\nUNION ALL\n".join(selects)


def _same(*names: str) -> dict:
    return {n: n for n in names}


# --------------------------------------------------------------------------
# supply & demand
# --------------------------------------------------------------------------

CTES["lead_metrics"] = f"""
SELECT country, service_type, lead_source, CAST(date_trunc('month', lead_date) AS DATE) AS month,
       {B('count(*)')} AS total_leads,
       {B('count(CASE WHEN is_converted THEN 1 END)')} AS converted_leads,
       {B("count(CASE WHEN lead_status = 'pending' THEN 1 END)")} AS pending_leads,
       {B("count(CASE WHEN lead_status = 'unassigned' THEN 1 END)")} AS unassigned_leads,
       {B("count(CASE WHEN lead_status = 'lost' THEN 1 END)")} AS lost_leads,
       {R('count(CASE WHEN is_converted THEN 1 END)', 'count(*)', 2, 100)} AS conversion_rate_pct,
       {R('count(CASE WHEN assigned_at IS NOT NULL THEN 1 END)', 'count(*)', 2, 100)} AS assignment_rate_pct,
       {R('sum(hours_to_assign)', 'count(hours_to_assign)', 1)} AS avg_hours_to_assign,
       {R('sum(days_to_convert)', 'count(days_to_convert)', 1)} AS avg_days_to_convert,
       {B('count(CASE WHEN hours_to_assign > 24 THEN 1 END)')} AS sla_breaches,
       {R('count(CASE WHEN hours_to_assign > 24 THEN 1 END)', 'count(CASE WHEN assigned_at IS NOT NULL THEN 1 END)', 2, 100)}
           AS sla_breach_rate_pct
FROM stg_leads GROUP BY 1, 2, 3, 4"""

CTES["mart_supply_demand"] = f"""
SELECT *, {R('unassigned_leads', 'total_leads', 2, 100)} AS unassigned_rate_pct,
       (CAST(unassigned_leads AS DOUBLE) / total_leads > 0.1) AS has_supply_gap
FROM lead_metrics"""


# --------------------------------------------------------------------------
# churn
# --------------------------------------------------------------------------

CTES["monthly_churn"] = f"""
SELECT CAST(date_trunc('month', COALESCE(churn_date, {AS_OF})) AS DATE) AS month,
       country, plan_type, churn_reason,
       {B('count(*)')} AS total_subscriptions,
       {B('count(CASE WHEN is_churned THEN 1 END)')} AS churned_count,
       {B('count(CASE WHEN is_active THEN 1 END)')} AS active_count,
       {B('sum(CASE WHEN is_churned THEN mrr ELSE 0 END)')} AS churned_mrr,
       {B('sum(CASE WHEN is_active THEN mrr ELSE 0 END)')} AS active_mrr,
       {R('count(CASE WHEN is_churned THEN 1 END)', 'count(*)', 2, 100)} AS churn_rate_pct,
       {R("sum(CASE WHEN is_churned THEN date_diff('day', start_date, churn_date) END)",
          "count(CASE WHEN is_churned THEN date_diff('day', start_date, churn_date) END)", 0)}
           AS avg_days_to_churn
FROM stg_subscriptions GROUP BY 1, 2, 3, 4"""

CTES["active_subscriptions"] = """
SELECT customer_id, start_date, is_active FROM stg_subscriptions WHERE is_active"""

CTES["overdue_invoices"] = """
SELECT * FROM stg_invoices WHERE is_currently_overdue"""

CTES["risk_base"] = f"""
SELECT customer_id, customer_name, country, segment, plan_type, mrr, start_date,
       date_diff('day', start_date, {AS_OF}) AS subscription_tenure_days
FROM stg_customers JOIN active_subscriptions USING (customer_id)"""

CTES["at_risk_customers"] = f"""
SELECT *, CASE WHEN risk_score >= 4 THEN 'high' WHEN risk_score >= 2 THEN 'medium'
               ELSE 'low' END AS churn_risk_level
FROM (
  SELECT customer_id, customer_name, country, segment, plan_type, mrr, start_date,
         subscription_tenure_days, nps_score, nps_category, last_survey_date,
         is_currently_overdue, days_overdue,
         CAST(CASE nps_category WHEN 'detractor' THEN 3 WHEN 'passive' THEN 1 ELSE 0 END
              + CASE WHEN is_currently_overdue THEN 2 ELSE 0 END
              + CASE WHEN subscription_tenure_days < 30 THEN 1 ELSE 0 END AS BIGINT)
             AS risk_score
  FROM risk_base
  LEFT JOIN (SELECT customer_id, nps_score, nps_category, survey_date AS last_survey_date
             FROM stg_nps_surveys) USING (customer_id)
  LEFT JOIN (SELECT customer_id, is_currently_overdue, days_overdue FROM overdue_invoices)
       USING (customer_id)
) scored"""

CTES["mart_churn"] = _union([  # fixed names, types and order
    ("record_type", "VARCHAR"),
    ("month", "DATE"),
    ("country", "VARCHAR"),
    ("plan_type", "VARCHAR"),
    ("churn_reason", "VARCHAR"),
    ("total_subscriptions", "BIGINT"),
    ("churned_count", "BIGINT"),
    ("active_count", "BIGINT"),
    ("churned_mrr", "BIGINT"),
    ("active_mrr", "BIGINT"),
    ("churn_rate_pct", "DOUBLE"),
    ("avg_days_to_churn", "DOUBLE"),
    ("customer_id", "VARCHAR"),
    ("customer_name", "VARCHAR"),
    ("segment", "VARCHAR"),
    ("mrr", "BIGINT"),
    ("nps_score", "BIGINT"),
    ("nps_category", "VARCHAR"),
    ("is_currently_overdue", "BOOLEAN"),
    ("days_overdue", "BIGINT"),
    ("risk_score", "BIGINT"),
    ("churn_risk_level", "VARCHAR"),
], [
    ("monthly_churn_summary", "monthly_churn", _same(
        "month", "country", "plan_type", "churn_reason", "total_subscriptions",
        "churned_count", "active_count", "churned_mrr", "active_mrr", "churn_rate_pct",
        "avg_days_to_churn")),
    ("at_risk_customer", "at_risk_customers", {**_same(
        "country", "plan_type", "customer_id", "customer_name", "segment", "mrr", "nps_score",
        "nps_category", "is_currently_overdue", "days_overdue", "risk_score",
        "churn_risk_level"), "active_mrr": "mrr"}),
])


# --------------------------------------------------------------------------
# upselling
# --------------------------------------------------------------------------

CTES["monthly_upsell"] = f"""
SELECT CAST(date_trunc('month', upsell_date) AS DATE) AS month, country, upsell_type, sales_rep,
       {B('count(*)')} AS upsell_count,
       {B('sum(incremental_revenue)')} AS total_incremental_revenue,
       {R('sum(incremental_revenue)', 'count(incremental_revenue)', 2)} AS avg_incremental_revenue,
       {B("count(CASE WHEN upsell_type = 'plan_upgrade' THEN 1 END)")} AS plan_upgrades,
       {B("count(CASE WHEN upsell_type = 'add_on_sale' THEN 1 END)")} AS add_on_sales,
       {B("sum(CASE WHEN upsell_type = 'plan_upgrade' THEN incremental_revenue ELSE 0 END)")}
           AS upgrade_revenue,
       {B("sum(CASE WHEN upsell_type = 'add_on_sale' THEN incremental_revenue ELSE 0 END)")}
           AS add_on_revenue
FROM stg_upsell_events GROUP BY 1, 2, 3, 4"""

CTES["eligible_customers"] = """
SELECT customer_id, country, segment, plan_type, mrr, tenure_days
FROM (SELECT * FROM stg_customers WHERE plan_type = 'basic' AND tenure_days >= 30)
JOIN (SELECT customer_id FROM active_subscriptions) USING (customer_id)"""

CTES["upsold_customers"] = "SELECT DISTINCT customer_id FROM stg_upsell_events"

CTES["attach_rate_by_segment"] = f"""
SELECT e.country, e.segment, {B('count(*)')} AS eligible_count,
       {B('count(CASE WHEN uc.customer_id IS NOT NULL THEN 1 END)')} AS upsold_count,
       {R('count(CASE WHEN uc.customer_id IS NOT NULL THEN 1 END)', 'count(*)', 2, 100)} AS upsell_attach_rate_pct,
       {B('sum(e.mrr)')} AS eligible_mrr_base,
       CAST(sum(e.mrr) * 0.9 AS DOUBLE) AS estimated_upsell_opportunity_mrr
FROM eligible_customers e LEFT JOIN upsold_customers uc ON e.customer_id = uc.customer_id
GROUP BY 1, 2"""

CTES["mart_upselling"] = _union([  # fixed names, types and order
    ("record_type", "VARCHAR"),
    ("month", "DATE"),
    ("country", "VARCHAR"),
    ("upsell_type", "VARCHAR"),
    ("sales_rep", "VARCHAR"),
    ("upsell_count", "BIGINT"),
    ("total_incremental_revenue", "BIGINT"),
    ("avg_incremental_revenue", "DOUBLE"),
    ("plan_upgrades", "BIGINT"),
    ("add_on_sales", "BIGINT"),
    ("upgrade_revenue", "BIGINT"),
    ("add_on_revenue", "BIGINT"),
    ("segment", "VARCHAR"),
    ("eligible_count", "BIGINT"),
    ("upsold_count", "BIGINT"),
    ("upsell_attach_rate_pct", "DOUBLE"),
    ("estimated_upsell_opportunity_mrr", "DOUBLE"),
], [
    ("monthly_upsell_performance", "monthly_upsell", _same(
        "month", "country", "upsell_type", "sales_rep", "upsell_count",
        "total_incremental_revenue", "avg_incremental_revenue", "plan_upgrades",
        "add_on_sales", "upgrade_revenue", "add_on_revenue")),
    ("attach_rate_by_segment", "attach_rate_by_segment", {**_same(
        "country", "segment", "eligible_count", "upsold_count", "upsell_attach_rate_pct",
        "estimated_upsell_opportunity_mrr"), "upsell_count": "upsold_count"}),
])


# --------------------------------------------------------------------------
# partner ROI (row-level joins, as the models state them)
# --------------------------------------------------------------------------

_ACTIVE_MRR = "CASE WHEN is_active THEN mrr ELSE 0 END"
_MONTHS = f"date_diff('month', start_date, COALESCE(end_date, {AS_OF}))"
# the rate at the 15 decimal places that a double below 1 holds
_RATE = "CAST(CAST(commission_rate AS VARCHAR) AS DECIMAL(18,15))"

# customer × subscription × partner rows, aggregated per referring partner
CTES["partner_revenue_x"] = f"""
SELECT partner_id,
       {B('count(DISTINCT customer_id)')} AS total_customers,
       {B('count(CASE WHEN is_active THEN 1 END)')} AS active_customers,
       {B('count(CASE WHEN is_churned THEN 1 END)')} AS churned_customers,
       {B(f'sum({_ACTIVE_MRR})')} AS active_mrr,
       {B('sum(mrr)')} AS total_mrr_ever,
       {R(f'sum({_ACTIVE_MRR}) * sum({_MONTHS})', f'count({_ACTIVE_MRR}) * count({_MONTHS})', 2)}
           AS estimated_avg_ltv,
       CAST(round(CAST(sum({_ACTIVE_MRR}) AS DECIMAL(20,0)) * max({_RATE}), 2) * 100 AS BIGINT)
           AS commission_cents
FROM (SELECT customer_id, partner_id FROM stg_customers)
JOIN (SELECT customer_id, is_active, is_churned, mrr, start_date, end_date
      FROM stg_subscriptions) USING (customer_id)
JOIN (SELECT partner_id, commission_rate FROM stg_partners) USING (partner_id)
GROUP BY partner_id"""

CTES["partner_revenue"] = """
SELECT partner_id, total_customers, active_customers, churned_customers, active_mrr,
       total_mrr_ever, estimated_avg_ltv,
       CAST(commission_cents AS DOUBLE) / 100 AS monthly_commission_owed
FROM partner_revenue_x"""

CTES["partner_leads"] = f"""
SELECT partner_id, {B('count(*)')} AS partner_leads,
       {B('count(CASE WHEN is_converted THEN 1 END)')} AS partner_lead_conversions,
       {R('count(CASE WHEN is_converted THEN 1 END)', 'count(*)', 2, 100)}
           AS partner_conversion_rate_pct
FROM (SELECT customer_id, is_converted FROM stg_leads WHERE lead_source = 'partner')
JOIN (SELECT customer_id, partner_id FROM stg_customers) USING (customer_id)
GROUP BY partner_id"""

_COST_CENTS = "(monthly_fee * 100 + COALESCE(commission_cents, 0))"
_NET_CENTS = f"(COALESCE(active_mrr, 0) * 100 - {_COST_CENTS})"
_FEES = "monthly_fee * partner_tenure_months"

CTES["mart_roi_partnerships"] = f"""
SELECT partner_id, partner_name, country, partner_type, contract_start_date, monthly_fee,
       commission_rate, partner_tenure_months,
       COALESCE(total_customers, 0) AS total_customers,
       COALESCE(active_customers, 0) AS active_customers,
       COALESCE(churned_customers, 0) AS churned_customers,
       COALESCE(active_mrr, 0) AS active_mrr,
       COALESCE(total_mrr_ever, 0) AS total_mrr_ever,
       COALESCE(estimated_avg_ltv, 0.0) AS estimated_avg_ltv,
       COALESCE(CAST(commission_cents AS DOUBLE) / 100, 0.0) AS monthly_commission_owed,
       COALESCE(partner_leads, 0) AS partner_leads,
       COALESCE(partner_lead_conversions, 0) AS partner_lead_conversions,
       COALESCE(partner_conversion_rate_pct, 0.0) AS partner_conversion_rate_pct,
       CAST({_COST_CENTS} AS DOUBLE) / 100 AS total_monthly_cost,
       CAST({_NET_CENTS} AS DOUBLE) / 100 AS net_monthly_value,
       {R(_NET_CENTS, _COST_CENTS, 2, 100)} AS roi_pct,
       {R(_FEES, 'COALESCE(active_mrr, 0)', 1)} AS payback_period_months,
       {R(_FEES, 'COALESCE(total_customers, 0)', 2)} AS cost_per_acquired_customer
FROM stg_partners
LEFT JOIN partner_revenue_x USING (partner_id)
LEFT JOIN partner_leads USING (partner_id)"""


# --------------------------------------------------------------------------
# debt collection
# --------------------------------------------------------------------------

# The aging buckets.
_BUCKET = """CASE WHEN days_overdue BETWEEN 1 AND 30 THEN '1-30 days'
            WHEN days_overdue BETWEEN 31 AND 60 THEN '31-60 days'
            WHEN days_overdue BETWEEN 61 AND 90 THEN '61-90 days'
            WHEN days_overdue > 90 THEN '90+ days' ELSE 'current' END"""

CTES["enriched_invoices"] = f"""
SELECT invoice_id, customer_id, issue_date, due_date, paid_date, amount, currency, status,
       country, CAST(days_overdue AS BIGINT) AS days_overdue, is_currently_overdue,
       customer_name, segment, plan_type, mrr, tenure_days,
       CASE WHEN is_currently_overdue THEN {_BUCKET} ELSE 'current' END AS aging_bucket
FROM stg_invoices
LEFT JOIN (SELECT customer_id, customer_name, segment, plan_type, mrr, tenure_days
           FROM stg_customers) USING (customer_id)"""

_OD_AMT = "sum(CASE WHEN is_currently_overdue THEN amount ELSE 0 END)"
_OD_DAYS = "CASE WHEN is_currently_overdue THEN days_overdue END"

CTES["debt_summary"] = f"""
SELECT CAST(date_trunc('month', issue_date) AS DATE) AS month, country, segment,
       {B('count(*)')} AS total_invoices, {B('sum(amount)')} AS total_invoiced,
       {B('count(CASE WHEN is_currently_overdue THEN 1 END)')} AS overdue_count,
       {B(_OD_AMT)} AS overdue_amount,
       {B("count(CASE WHEN status = 'paid_late' THEN 1 END)")} AS paid_late_count,
       {B("sum(CASE WHEN status = 'paid_late' THEN amount ELSE 0 END)")} AS paid_late_amount,
       {B("count(CASE WHEN status = 'paid' THEN 1 END)")} AS paid_ontime_count,
       {B("sum(CASE WHEN status = 'paid' THEN amount ELSE 0 END)")} AS paid_ontime_amount,
       {R('count(CASE WHEN is_currently_overdue THEN 1 END)', 'count(*)', 2, 100)} AS overdue_rate_pct,
       {R("count(CASE WHEN status = 'paid_late' THEN 1 END)",
          "count(CASE WHEN status = 'paid_late' THEN 1 END) + count(CASE WHEN is_currently_overdue THEN 1 END)", 2, 100)}
           AS recovery_rate_pct,
       {R(_OD_AMT, 'sum(amount)', 1, 30)} AS dso_days,
       {R(f'sum({_OD_DAYS})', f'count({_OD_DAYS})', 1)} AS avg_days_overdue
FROM enriched_invoices GROUP BY 1, 2, 3"""

CTES["aging_breakdown"] = f"""
SELECT country, segment, aging_bucket, {B('count(*)')} AS invoice_count,
       {B('sum(amount)')} AS total_amount,
       {R('sum(days_overdue)', 'count(days_overdue)', 1)} AS avg_days_overdue
FROM enriched_invoices WHERE is_currently_overdue GROUP BY 1, 2, 3"""

CTES["high_risk_debtors"] = f"""
SELECT customer_id, customer_name, country, segment, plan_type, mrr,
       {B('count(*)')} AS overdue_invoice_count, {B('sum(amount)')} AS total_overdue_amount,
       {B('max(days_overdue)')} AS max_days_overdue, max(aging_bucket) AS worst_aging_bucket
FROM enriched_invoices WHERE is_currently_overdue GROUP BY 1, 2, 3, 4, 5, 6"""

CTES["mart_debt_collection"] = _union([  # fixed names, types and order
    ("record_type", "VARCHAR"),
    ("month", "DATE"),
    ("country", "VARCHAR"),
    ("segment", "VARCHAR"),
    ("total_invoices", "BIGINT"),
    ("total_invoiced", "BIGINT"),
    ("overdue_count", "BIGINT"),
    ("overdue_amount", "BIGINT"),
    ("paid_late_count", "BIGINT"),
    ("paid_late_amount", "BIGINT"),
    ("paid_ontime_count", "BIGINT"),
    ("paid_ontime_amount", "BIGINT"),
    ("overdue_rate_pct", "DOUBLE"),
    ("recovery_rate_pct", "DOUBLE"),
    ("dso_days", "DOUBLE"),
    ("avg_days_overdue", "DOUBLE"),
    ("aging_bucket", "VARCHAR"),
    ("customer_id", "VARCHAR"),
    ("customer_name", "VARCHAR"),
    ("plan_type", "VARCHAR"),
    ("mrr", "BIGINT"),
    ("overdue_invoice_count", "BIGINT"),
    ("total_overdue_amount", "BIGINT"),
    ("max_days_overdue", "BIGINT"),
], [
    ("monthly_debt_summary", "debt_summary", _same(
        "month", "country", "segment", "total_invoices", "total_invoiced", "overdue_count",
        "overdue_amount", "paid_late_count", "paid_late_amount", "paid_ontime_count",
        "paid_ontime_amount", "overdue_rate_pct", "recovery_rate_pct", "dso_days",
        "avg_days_overdue")),
    ("aging_breakdown", "aging_breakdown", {
        **_same("country", "segment", "avg_days_overdue", "aging_bucket"),
        "total_invoices": "invoice_count", "overdue_count": "invoice_count",
        "total_invoiced": "total_amount", "overdue_amount": "total_amount"}),
    ("high_risk_debtors", "high_risk_debtors", {
        **_same("country", "segment", "customer_id", "customer_name", "plan_type", "mrr",
                "overdue_invoice_count", "total_overdue_amount", "max_days_overdue"),
        "total_invoices": "overdue_invoice_count", "overdue_count": "overdue_invoice_count",
        "total_invoiced": "total_overdue_amount", "overdue_amount": "total_overdue_amount",
        "avg_days_overdue": "max_days_overdue", "aging_bucket": "worst_aging_bucket"}),
])


# --------------------------------------------------------------------------
# customer satisfaction
# --------------------------------------------------------------------------

CTES["enriched_surveys"] = """
SELECT survey_id, customer_id, survey_date, nps_score, csat_score, nps_category, is_satisfied,
       comment, customer_name, country, segment, plan_type, mrr, is_active
FROM (SELECT survey_id, customer_id, survey_date, nps_score, csat_score, nps_category,
             is_satisfied, comment FROM stg_nps_surveys)
LEFT JOIN (SELECT customer_id, customer_name, country, segment, plan_type, mrr
           FROM stg_customers) USING (customer_id)
LEFT JOIN (SELECT customer_id, is_active FROM active_subscriptions) USING (customer_id)"""

CTES["nps_monthly"] = f"""
SELECT CAST(date_trunc('month', survey_date) AS DATE) AS month, country, segment, plan_type,
       {B('count(*)')} AS survey_responses,
       {B("count(CASE WHEN nps_category = 'promoter' THEN 1 END)")} AS promoters,
       {B("count(CASE WHEN nps_category = 'passive' THEN 1 END)")} AS passives,
       {B("count(CASE WHEN nps_category = 'detractor' THEN 1 END)")} AS detractors,
       {R("count(CASE WHEN nps_category = 'promoter' THEN 1 END) - count(CASE WHEN nps_category = 'detractor' THEN 1 END)",
          'count(*)', 1, 100)} AS nps_score,
       {R('count(CASE WHEN is_satisfied THEN 1 END)', 'count(*)', 1, 100)} AS csat_pct,
       {R('sum(nps_score)', 'count(nps_score)', 2)} AS avg_nps_raw,
       {R('sum(csat_score)', 'count(csat_score)', 2)} AS avg_csat_raw,
       {B("sum(CASE WHEN nps_category = 'detractor' THEN mrr ELSE 0 END)")}
           AS detractor_mrr_at_risk,
       {B('sum(mrr)')} AS total_surveyed_mrr
FROM enriched_surveys GROUP BY 1, 2, 3, 4"""

CTES["detractor_detail"] = """
SELECT customer_id, customer_name, country, segment, plan_type, mrr, nps_score, csat_score,
       survey_date, comment, is_active,
       -- every row here is a detractor, and is_active is TRUE or NULL (outer join)
       is_active AS is_active_detractor
FROM enriched_surveys WHERE nps_category = 'detractor'"""

CTES["response_rate"] = f"""
SELECT surveyed.country,
       {B('count(DISTINCT surveyed.customer_id)')} AS surveyed_customers,
       {B('count(DISTINCT everyone.customer_id)')} AS active_customers,
       {R('count(DISTINCT surveyed.customer_id)', 'count(DISTINCT everyone.customer_id)', 1, 100)}
           AS response_rate_pct
FROM (SELECT customer_id FROM stg_customers) everyone
LEFT JOIN (SELECT customer_id, country FROM enriched_surveys) surveyed
       ON surveyed.customer_id = everyone.customer_id
GROUP BY surveyed.country"""

CTES["mart_customer_satisfaction"] = _union([  # fixed names, types and order
    ("record_type", "VARCHAR"),
    ("month", "DATE"),
    ("country", "VARCHAR"),
    ("segment", "VARCHAR"),
    ("plan_type", "VARCHAR"),
    ("survey_responses", "BIGINT"),
    ("promoters", "BIGINT"),
    ("passives", "BIGINT"),
    ("detractors", "BIGINT"),
    ("nps_score", "DOUBLE"),
    ("csat_pct", "DOUBLE"),
    ("avg_nps_raw", "DOUBLE"),
    ("avg_csat_raw", "DOUBLE"),
    ("detractor_mrr_at_risk", "BIGINT"),
    ("total_surveyed_mrr", "BIGINT"),
    ("customer_id", "VARCHAR"),
    ("customer_name", "VARCHAR"),
    ("mrr", "BIGINT"),
    ("nps_score_raw", "BIGINT"),
    ("csat_score_raw", "BIGINT"),
    ("comment", "VARCHAR"),
    ("is_active", "BOOLEAN"),
    ("is_active_detractor", "BOOLEAN"),
    ("surveyed_customers", "BIGINT"),
    ("active_customers", "BIGINT"),
    ("response_rate_pct", "DOUBLE"),
], [
    ("nps_monthly", "nps_monthly", _same(
        "month", "country", "segment", "plan_type", "survey_responses", "promoters",
        "passives", "detractors", "nps_score", "csat_pct", "avg_nps_raw", "avg_csat_raw",
        "detractor_mrr_at_risk", "total_surveyed_mrr")),
    ("detractor_detail", "detractor_detail", {
        **_same("country", "segment", "plan_type", "customer_id", "customer_name", "mrr",
                "comment", "is_active", "is_active_detractor"),
        "detractor_mrr_at_risk": "mrr", "total_surveyed_mrr": "mrr",
        "nps_score_raw": "nps_score", "csat_score_raw": "csat_score"}),
    ("response_rate", "response_rate", {
        **_same("country", "surveyed_customers", "active_customers", "response_rate_pct"),
        "survey_responses": "surveyed_customers"}),
])


# --------------------------------------------------------------------------
# macro applications
# --------------------------------------------------------------------------

CTES["safe_divide"] = """
SELECT invoice_id, amount, days_overdue,
       CASE WHEN days_overdue = 0 OR days_overdue IS NULL THEN 0.0
            ELSE amount / days_overdue END AS amount_per_overdue_day
FROM stg_invoices"""

CTES["pct"] = f"""
SELECT country, currency, {B('count(*)')} AS invoices,
       {B('count(CASE WHEN is_currently_overdue THEN 1 END)')} AS overdue,
       CASE WHEN count(*) = 0 THEN 0.0
            ELSE {R('count(CASE WHEN is_currently_overdue THEN 1 END)', 'count(*)', 2, 100)} END AS overdue_pct
FROM stg_invoices GROUP BY 1, 2"""

CTES["nps_score"] = f"""
SELECT country, CAST(date_trunc('month', survey_date) AS DATE) AS month,
       {B("count(CASE WHEN nps_category = 'promoter' THEN 1 END)")} AS promoters,
       {B("count(CASE WHEN nps_category = 'detractor' THEN 1 END)")} AS detractors,
       {B('count(*)')} AS responses,
       {R("count(CASE WHEN nps_category = 'promoter' THEN 1 END) - count(CASE WHEN nps_category = 'detractor' THEN 1 END)",
          'count(*)', 1, 100)} AS nps
FROM stg_nps_surveys GROUP BY 1, 2"""

CTES["date_spine_months"] = """
SELECT country, date_month FROM (
  SELECT country, CAST(start_date + to_months(CAST(n AS INTEGER)) AS DATE) AS date_month, end_date
  FROM (SELECT country, min(issue_date) AS start_date, max(due_date) AS end_date
        FROM stg_invoices GROUP BY 1) b,
       LATERAL (SELECT unnest(range(0, date_diff('month', b.start_date, b.end_date))) AS n) g
) t WHERE date_month <= end_date"""

CTES["aging_bucket"] = f"""
SELECT invoice_id, days_overdue, {_BUCKET} AS aging_bucket
FROM stg_invoices"""

CTES["classify_nps"] = """
SELECT survey_id, nps_score,
       CASE WHEN nps_score >= 9 THEN 'promoter' WHEN nps_score >= 7 THEN 'passive'
            WHEN nps_score <= 6 THEN 'detractor' END AS nps_category
FROM stg_nps_surveys"""


# --------------------------------------------------------------------------
# data quality: one summary row per declared check
# --------------------------------------------------------------------------

def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# The declared checks, by model and kind.  not_null and unique name
# columns; accepted values give a column and its list; ranges a condition that holds.
_COUNTRIES = "'DK', 'NO', 'SE', 'DE', 'NL', 'US'"
_PLANS = "'basic', 'premium', 'enterprise'"
_NOT_NULL = {
    "stg_customers": ["customer_id", "customer_name", "country", "segment", "plan_type", "mrr"],
    "stg_subscriptions": ["subscription_id", "customer_id", "plan_type", "mrr", "is_active", "is_churned"],
    "stg_leads": ["lead_id", "customer_id", "country", "is_converted"],
    "stg_invoices": ["invoice_id", "customer_id", "amount"],
    "stg_partners": ["partner_id", "commission_rate"],
    "stg_nps_surveys": ["survey_id", "customer_id", "nps_score", "csat_score"],
    "stg_upsell_events": ["upsell_id", "customer_id", "incremental_revenue"],
    "mart_supply_demand": ["country", "month"],
    "mart_churn": ["record_type"],
    "mart_upselling": ["record_type"],
    "mart_roi_partnerships": ["partner_id"],
    "mart_debt_collection": ["record_type"],
    "mart_customer_satisfaction": ["record_type"],
}
_UNIQUE = {
    "stg_customers": "customer_id",
    "stg_subscriptions": "subscription_id",
    "stg_leads": "lead_id",
    "stg_invoices": "invoice_id",
    "stg_partners": "partner_id",
    "stg_nps_surveys": "survey_id",
    "stg_upsell_events": "upsell_id",
    "mart_roi_partnerships": "partner_id",
}
_ACCEPTED = [
    ("stg_customers", "country", _COUNTRIES),
    ("stg_customers", "segment", "'SMB', 'MID', 'ENT'"),
    ("stg_customers", "plan_type", _PLANS),
    ("stg_subscriptions", "plan_type", _PLANS),
    ("stg_subscriptions", "churn_reason", "'price_too_high', 'competitor', 'not_using'"),
    ("stg_leads", "country", _COUNTRIES),
    ("stg_leads", "lead_status", "'converted', 'pending', 'unassigned', 'lost'"),
    ("stg_invoices", "status", "'paid', 'overdue', 'paid_late'"),
    ("stg_partners", "status", "'active', 'inactive'"),
    ("stg_nps_surveys", "nps_category", "'promoter', 'passive', 'detractor'"),
    ("stg_upsell_events", "upsell_type", "'plan_upgrade', 'add_on_sale', 'unknown'"),
    ("mart_churn", "record_type", "'monthly_churn_summary', 'at_risk_customer'"),
    ("mart_upselling", "record_type", "'monthly_upsell_performance', 'attach_rate_by_segment'"),
    ("mart_debt_collection", "record_type",
     "'monthly_debt_summary', 'aging_breakdown', 'high_risk_debtors'"),
    ("mart_customer_satisfaction", "record_type",
     "'nps_monthly', 'detractor_detail', 'response_rate'"),
]
_CUSTOMERS_OF = ["stg_subscriptions", "stg_invoices", "stg_upsell_events"]
_RANGES = [
    ("stg_customers", "mrr", "mrr > 0"),
    ("stg_invoices", "amount", "amount > 0"),
    ("stg_partners", "commission_rate", "commission_rate >= 0 AND commission_rate <= 1"),
    ("stg_nps_surveys", "nps_score", "nps_score >= 0 AND nps_score <= 10"),
    ("stg_nps_surveys", "csat_score", "csat_score >= 1 AND csat_score <= 5"),
    ("stg_upsell_events", "incremental_revenue", "incremental_revenue >= 0"),
    ("mart_supply_demand", "conversion_rate_pct",
     "conversion_rate_pct >= 0 AND conversion_rate_pct <= 100"),
]


def _checks() -> list:
    """(model, column, kind, SQL that counts its failures) of every declared check."""
    out = [(m, c, "not_null", f"SELECT count(*) FROM {m} WHERE {c} IS NULL")
           for m, columns in _NOT_NULL.items() for c in columns]
    out += [(m, c, "unique", f"SELECT count(*) FROM (SELECT {c} FROM {m} WHERE {c} IS NOT NULL "
             f"GROUP BY {c} HAVING count(*) > 1)") for m, c in _UNIQUE.items()]
    out += [(m, c, "accepted_values", f"SELECT count(DISTINCT {c}) FROM {m} WHERE {c} NOT IN ({values})")
            for m, c, values in _ACCEPTED]
    out += [(m, "customer_id", "relationships", f"SELECT count(*) FROM {m} WHERE customer_id IS NOT NULL "
             "AND customer_id NOT IN (SELECT customer_id FROM stg_customers)") for m in _CUSTOMERS_OF]
    return out + [(m, c, "between", f"SELECT count(*) FROM {m} WHERE NOT ({holds})") for m, c, holds in _RANGES]


def _dq_sql(kinds) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {_q(m)} AS model, {_q(c)} AS column_name, {_q(kind)} AS check_name, "
        f"CAST(({body}) AS BIGINT) AS failures" for m, c, kind, body in _checks() if kind in kinds)


CTES["dq_unique"] = _dq_sql({"unique"})
CTES["dq_not_null"] = _dq_sql({"not_null"})
CTES["dq_accepted_values"] = _dq_sql({"accepted_values"})
CTES["dq_relationships"] = _dq_sql({"relationships"})
CTES["dq_between"] = _dq_sql({"between"})
CTES["dq_suite"] = _dq_sql({"unique", "not_null", "accepted_values", "relationships", "between"})

# an empty field of a CSV file is null, whatever was written
_CSV_TEXT = {
    "leads": ["assigned_at", "converted_at"],
    "customers": ["partner_id"],
    "subscriptions": ["end_date", "churn_date"],
    "partners": ["status"],
    "nps_surveys": ["customer_id"],
    "upsell_events": ["add_on"],
}


def _from_csv(source: str) -> str:
    nulled = ", ".join(f"NULLIF({c}, '') AS {c}" for c in _CSV_TEXT[source])
    return f"SELECT * REPLACE ({nulled}) FROM src_{source}"


CTES["read_source_csv"] = _from_csv("leads")
CTES["read_source_headers"] = _from_csv("leads")
for _name in ("customers", "subscriptions", "partners", "nps_surveys", "upsell_events"):
    CTES[f"read_source_{_name}"] = _from_csv(_name)

CTES["read_source_parquet"] = "SELECT * FROM src_invoices"

CTES["dq_failing_unique"] = """
SELECT customer_id, count(*) AS n_records FROM stg_invoices
WHERE customer_id IS NOT NULL GROUP BY customer_id HAVING count(*) > 1"""

CTES["dq_failing_not_null"] = """
SELECT invoice_id, country, amount FROM stg_invoices WHERE customer_id IS NULL"""

CTES["dq_failing_accepted_values"] = """
SELECT lead_status AS value_field, count(*) AS n_records FROM src_leads
WHERE lead_status NOT IN ('converted', 'pending', 'unassigned') GROUP BY lead_status"""

CTES["dq_failing_relationships"] = """
SELECT invoice_id, customer_id FROM stg_invoices ANTI JOIN stg_customers USING (customer_id)
WHERE customer_id IS NOT NULL"""

CTES["dq_failing_between"] = """
SELECT survey_id, nps_score FROM stg_nps_surveys WHERE nps_score <= 2 OR nps_score >= 9"""

# invoices with faults: a line with a field too many, no number, no date
CTES["dirty_invoices"] = """
SELECT *, k % 101 = 9 AS bad_line, k % 97 IN (3, 5) AS bad_amount, k % 89 = 7 AS bad_due
FROM (SELECT *, CAST(substr(invoice_id, 4) AS BIGINT) AS k FROM src_invoices)"""

CTES["read_source_rejects"] = """
SELECT 'invoices' AS source, CAST(NULL AS VARCHAR) AS column_name, 'malformed line' AS reason, count(*) AS rejected
FROM dirty_invoices WHERE bad_line HAVING count(*) > 0
UNION ALL
SELECT 'invoices', 'amount', 'not a number', count(*) FROM dirty_invoices WHERE bad_amount AND NOT bad_line HAVING count(*) > 0
UNION ALL
SELECT 'invoices', 'due_date', 'not a date', count(*) FROM dirty_invoices WHERE bad_due AND NOT bad_line HAVING count(*) > 0"""

CTES["read_source_accepted"] = """
SELECT * EXCLUDE (k, bad_line, bad_amount, bad_due) REPLACE (NULLIF(paid_date, '') AS paid_date)
FROM dirty_invoices WHERE NOT (bad_line OR bad_amount OR bad_due)"""

# --------------------------------------------------------------------------
# presentation order: the declared keys, then all columns
# --------------------------------------------------------------------------

# Declared order of each mart; descending keys are nulls last where the
# models say so, and keys without a word on nulls sort them as the highest value.
_ORDERS = {
    "supply_demand": "t.month DESC NULLS FIRST, t.country ASC NULLS LAST, t.service_type ASC NULLS LAST",
    "churn": "t.record_type ASC NULLS LAST, t.month DESC NULLS LAST, t.churn_risk_level ASC NULLS LAST",
    "upselling": "t.record_type ASC NULLS LAST, t.month DESC NULLS LAST",
    "roi_partnerships": "t.roi_pct DESC NULLS FIRST",
    "debt_collection": "t.record_type ASC NULLS LAST, t.month DESC NULLS LAST",
    "customer_satisfaction": "t.record_type ASC NULLS LAST, t.month DESC NULLS LAST",
}
for _name, _keys in _ORDERS.items():
    CTES[f"present_{_name}"] = (f"SELECT t.*, row_number() OVER (ORDER BY {_keys}, t ASC NULLS LAST) AS position "
                                f"FROM mart_{_name} t")

# --------------------------------------------------------------------------
# sinks, and statements over the models
# --------------------------------------------------------------------------

CTES["sink_mart"] = "SELECT * FROM mart_debt_collection"
CTES["sink_mart_month"] = "SELECT * FROM mart_churn WHERE month >= DATE '2023-04-01'"

CTES["sql_supply_demand"] = f"""
SELECT country, {B('sum(total_leads)')} AS leads, {B('sum(converted_leads)')} AS converted
FROM mart_supply_demand GROUP BY country"""
CTES["sql_churn"] = """
SELECT c.segment, r.churn_risk_level, count(*) AS at_risk_rows, count(DISTINCT r.customer_id) AS customers
FROM at_risk_customers r JOIN stg_customers c USING (customer_id) GROUP BY ALL"""
CTES["sql_upselling"] = """
SELECT record_type, count(*) AS n, count(DISTINCT country) AS countries FROM mart_upselling GROUP BY record_type"""
CTES["sql_roi_partnerships"] = """
SELECT p.country, p.status, count(*) AS partners, count(CASE WHEN r.roi_pct > 0 THEN 1 END) AS gaining
FROM mart_roi_partnerships r JOIN stg_partners p USING (partner_id) GROUP BY ALL"""
CTES["sql_debt_collection"] = """
SELECT record_type, country, count(*) AS n FROM mart_debt_collection GROUP BY ALL"""
CTES["sql_customer_satisfaction"] = f"""
SELECT country, {B('sum(survey_responses)')} AS responses, {B('sum(detractors)')} AS detractors
FROM nps_monthly GROUP BY country"""

# Helper CTEs that are not queries of their own.
_INTERNAL = {"partner_revenue_x", "active_subscriptions", "overdue_invoices", "risk_base", "dirty_invoices"}

# Sources in which one customer has every 200th subscription and invoice and every 50th survey.
_SKEWED = {"src_subscriptions": ("subscription_id, 2", 200), "src_invoices": ("invoice_id, 4", 200),
           "src_nps_surveys": ("survey_id, 3", 50)}
_SKEWED_QUERIES = ["at_risk_customers", "enriched_surveys", "mart_churn", "mart_customer_satisfaction"]


def _skewed(source: str) -> str:
    number, every = _SKEWED[source]
    return (f"SELECT * REPLACE (CASE WHEN CAST(substr({number}) AS BIGINT) % {every} = 1 THEN 'C1' "
            f"ELSE customer_id END AS customer_id) FROM ({CTES[source]}\n)")


def _statement(name: str, skewed: bool = False) -> str:
    """``WITH <every CTE defined before name> SELECT * FROM <name>``."""
    order = list(CTES)
    upto = order[:order.index(name) + 1]
    # the DQ suites reference staging and marts, which are all defined earlier
    withs = ",\n".join(f"{n} AS ({_skewed(n) if skewed and n in _SKEWED else CTES[n]}\n)" for n in upto)
    return f"WITH {withs}\nSELECT * FROM {name}"


def oracle_sql() -> dict:
    """Query name → DuckDB SQL (sources included; no views beyond the driver's)."""
    names = [n for n in CTES if not n.startswith("src_") and n not in _INTERNAL]
    return {**{n: _statement(n) for n in names},
            **{f"skewed_{n}": _statement(n, skewed=True) for n in _SKEWED_QUERIES}}

"""Debt collection: monthly debt summary, aging buckets and overdue debtors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.kpi import (
    aging_bucket, lexical_max_bucket_sql, month_start, round_ratio_sql, sql_exprs,
)
from kpiloom.operators.union import conform


def enriched_invoices(inv: DataFrame, cust: DataFrame) -> DataFrame:
    """Invoices with customer attributes (fact ⟕ dimension) and an aging bucket.

    Only currently overdue invoices get a day bucket; all others are 'current'.
    The invoice's own ``country`` is kept.
    """
    overdue = F.col("is_currently_overdue")
    return (inv.join(cust.select("customer_id", "customer_name", "segment", "plan_type",
                                 "mrr", "tenure_days"), "customer_id", "left")
            .withColumn("aging_bucket",
                        F.when(overdue, aging_bucket("days_overdue"))
                        .otherwise(F.lit("current")))
            .select("invoice_id", "customer_id", "issue_date", "due_date", "paid_date",
                    "amount", "currency", "status", "country", "days_overdue",
                    "is_currently_overdue", "customer_name", "segment", "plan_type", "mrr",
                    "tenure_days", "aging_bucket"))


def debt_summary(enriched: DataFrame) -> DataFrame:
    total, overdue_n = "count(1)", "count_if(is_currently_overdue)"
    late_n = "count_if(status = 'paid_late')"
    overdue_amt = "sum(IF(is_currently_overdue, amount, 0))"
    od_days = "CASE WHEN is_currently_overdue THEN days_overdue END"
    return (enriched
            .groupBy(month_start("issue_date").alias("month"), "country", "segment")
            .agg(*sql_exprs(
                f"{total} AS total_invoices",
                "sum(amount) AS total_invoiced",
                f"{overdue_n} AS overdue_count",
                f"{overdue_amt} AS overdue_amount",
                f"{late_n} AS paid_late_count",
                "sum(IF(status = 'paid_late', amount, 0)) AS paid_late_amount",
                "count_if(status = 'paid') AS paid_ontime_count",
                "sum(IF(status = 'paid', amount, 0)) AS paid_ontime_amount",
                f"{round_ratio_sql(overdue_n, total, 2, 100)} AS overdue_rate_pct",
                f"{round_ratio_sql(late_n, f'{late_n} + {overdue_n}', 2, 100)} "
                "AS recovery_rate_pct",
                f"{round_ratio_sql(overdue_amt, 'sum(amount)', 1, 30)} AS dso_days",
                f"{round_ratio_sql(f'sum({od_days})', f'count({od_days})', 1)} "
                "AS avg_days_overdue")))


def aging_breakdown(enriched: DataFrame) -> DataFrame:
    return (enriched.filter("is_currently_overdue")
            .groupBy("country", "segment", "aging_bucket")
            .agg(*sql_exprs(
                "count(1) AS invoice_count",
                "sum(amount) AS total_amount",
                f"{round_ratio_sql('sum(days_overdue)', 'count(days_overdue)', 1)} "
                "AS avg_days_overdue")))


def high_risk_debtors(inv: DataFrame, cust: DataFrame) -> DataFrame:
    """Every customer with a currently overdue invoice (no threshold, no limit).

    Overdue invoices are summed per customer and invoice market before they meet
    the customers, so a customer with very many of them is a few rows of the join.
    ``worst_aging_bucket`` is the lexical maximum of the bucket labels (so
    'current' outranks '90+ days'), aggregated as an integer rank.
    """
    per_customer = (inv.filter("is_currently_overdue")
                    .select("customer_id", "country", "amount", "days_overdue",
                            aging_bucket("days_overdue").alias("aging_bucket"))
                    .groupBy("customer_id", "country")
                    .agg(*sql_exprs(
                        "count(1) AS _n", "sum(amount) AS _amount", "max(days_overdue) AS _days",
                        f"{lexical_max_bucket_sql('aging_bucket')} AS _bucket")))
    return (per_customer
            .join(cust.select("customer_id", "customer_name", "segment", "plan_type", "mrr"),
                  "customer_id", "left")
            .groupBy("customer_id", "customer_name", "country", "segment", "plan_type", "mrr")
            .agg(*sql_exprs(
                "sum(_n) AS overdue_invoice_count",
                "sum(_amount) AS total_overdue_amount",
                "max(_days) AS max_days_overdue",
                f"{lexical_max_bucket_sql('_bucket')} AS worst_aging_bucket")))


MART_DEBT_COLUMNS = [
    ("record_type", "string"), ("month", "date"), ("country", "string"),
    ("segment", "string"), ("total_invoices", "bigint"), ("total_invoiced", "bigint"),
    ("overdue_count", "bigint"), ("overdue_amount", "bigint"), ("paid_late_count", "bigint"),
    ("paid_late_amount", "bigint"), ("paid_ontime_count", "bigint"),
    ("paid_ontime_amount", "bigint"), ("overdue_rate_pct", "double"),
    ("recovery_rate_pct", "double"), ("dso_days", "double"), ("avg_days_overdue", "double"),
    ("aging_bucket", "string"), ("customer_id", "string"), ("customer_name", "string"),
    ("plan_type", "string"), ("mrr", "bigint"), ("overdue_invoice_count", "bigint"),
    ("total_overdue_amount", "bigint"), ("max_days_overdue", "bigint"),
]


def mart_debt_collection(inv: DataFrame, cust: DataFrame) -> DataFrame:
    """All three record types from one join and one grouping-sets aggregate.

    The invoice ⟕ customer join runs once; every joined row feeds three
    grouping sets — (month, market, segment), (market, segment, bucket) and
    (debtor) — in a single partial + final aggregation.  The bucket and debtor
    keys are nulled on rows that are not currently overdue, so those rows
    collapse map-side into one placeholder group per market and segment, and
    every aging / debtor measure counts overdue rows only; placeholder groups
    (no bucket, or no overdue row) are dropped.  Same rows as
    :func:`debt_summary`, :func:`aging_breakdown` and :func:`high_risk_debtors`
    unioned, without re-reading the join three times.
    """
    od = "is_currently_overdue"
    rows = enriched_invoices(inv, cust).selectExpr(
        "trunc(issue_date, 'MM') AS month", "country", "segment", "amount", "status", od,
        "days_overdue", "aging_bucket",
        f"IF({od}, aging_bucket, NULL) AS _bucket",
        *[f"IF({od}, {c}, NULL) AS _d_{c}" for c in ("customer_id", "customer_name",
                                                     "plan_type", "mrr")])
    debtor = ["_d_customer_id", "_d_customer_name", "country", "segment", "_d_plan_type",
              "_d_mrr"]
    keys = ["month", "country", "segment", "_bucket", "_d_customer_id", "_d_customer_name",
            "_d_plan_type", "_d_mrr"]
    total, od_n, late_n = "count(1)", f"count_if({od})", "count_if(status = 'paid_late')"
    od_amount0 = f"sum(IF({od}, amount, 0))"
    od_days = f"IF({od}, days_overdue, NULL)"
    grouped = (rows.groupingSets([["month", "country", "segment"],
                                  ["country", "segment", "_bucket"], debtor], *keys)
               .agg(*sql_exprs(
                   "grouping(month) AS _g_month", "grouping(_bucket) AS _g_bucket",
                   f"{total} AS _n", "sum(amount) AS _amount", f"{od_n} AS _od_n",
                   f"{od_amount0} AS _od_amount0",
                   f"sum(IF({od}, amount, NULL)) AS _od_amount",
                   f"{late_n} AS _late_n",
                   "sum(IF(status = 'paid_late', amount, 0)) AS _late_amount",
                   "count_if(status = 'paid') AS _paid_n",
                   "sum(IF(status = 'paid', amount, 0)) AS _paid_amount",
                   f"{round_ratio_sql(od_n, total, 2, 100)} AS _od_rate",
                   f"{round_ratio_sql(late_n, f'{late_n} + {od_n}', 2, 100)} AS _recovery",
                   f"{round_ratio_sql(od_amount0, 'sum(amount)', 1, 30)} AS _dso",
                   f"{round_ratio_sql(f'sum({od_days})', f'count({od_days})', 1)} AS _od_avg",
                   f"max({od_days}) AS _od_max",
                   f"{lexical_max_bucket_sql(f'IF({od}, aging_bucket, NULL)')} AS _worst")))
    summary, aging = "_g_month = 0", "_g_month = 1 AND _g_bucket = 0"

    def pick(for_summary: str, for_aging: str, for_debtor: str) -> str:
        return (f"CASE WHEN {summary} THEN {for_summary} WHEN {aging} THEN {for_aging} "
                f"ELSE {for_debtor} END")

    kept = grouped.filter(f"({summary}) OR ({aging} AND _bucket IS NOT NULL) "
                          f"OR (_g_month = 1 AND _g_bucket = 1 AND _od_n > 0)")
    return conform(
        kept, MART_DEBT_COLUMNS,
        record_type=pick("'monthly_debt_summary'", "'aging_breakdown'", "'high_risk_debtors'"),
        total_invoices=pick("_n", "_od_n", "_od_n"),
        total_invoiced=pick("_amount", "_od_amount", "_od_amount"),
        overdue_count="_od_n",
        overdue_amount=pick("_od_amount0", "_od_amount", "_od_amount"),
        paid_late_count=pick("_late_n", "NULL", "NULL"),
        paid_late_amount=pick("_late_amount", "NULL", "NULL"),
        paid_ontime_count=pick("_paid_n", "NULL", "NULL"),
        paid_ontime_amount=pick("_paid_amount", "NULL", "NULL"),
        overdue_rate_pct=pick("_od_rate", "NULL", "NULL"),
        recovery_rate_pct=pick("_recovery", "NULL", "NULL"),
        dso_days=pick("_dso", "NULL", "NULL"),
        avg_days_overdue=pick("_od_avg", "_od_avg", "_od_max"),
        aging_bucket=pick("NULL", "_bucket", "_worst"),
        customer_id="_d_customer_id", customer_name="_d_customer_name",
        plan_type="_d_plan_type", mrr="_d_mrr",
        overdue_invoice_count=pick("NULL", "NULL", "_od_n"),
        total_overdue_amount=pick("NULL", "NULL", "_od_amount"),
        max_days_overdue=pick("NULL", "NULL", "_od_max"))


DEBT_ORDER = [("record_type", "asc", "last"), ("month", "desc", "last")]

"""Upselling: monthly upsell performance and attach rate of eligible customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.config import DEFAULT_CONFIG, KpiConfig
from kpiloom.functions.kpi import decimal_sql, month_start, round_ratio_sql, sql_exprs
from kpiloom.operators.union import conform, union_records


def monthly_upsell(ups: DataFrame) -> DataFrame:
    rev = "incremental_revenue"
    return (ups
            .groupBy(month_start("upsell_date").alias("month"), "country", "upsell_type",
                     "sales_rep")
            .agg(*sql_exprs(
                "count(1) AS upsell_count",
                f"sum({rev}) AS total_incremental_revenue",
                f"{round_ratio_sql(f'sum({rev})', f'count({rev})', 2)} "
                "AS avg_incremental_revenue",
                "count_if(upsell_type = 'plan_upgrade') AS plan_upgrades",
                "count_if(upsell_type = 'add_on_sale') AS add_on_sales",
                f"sum(IF(upsell_type = 'plan_upgrade', {rev}, 0)) AS upgrade_revenue",
                f"sum(IF(upsell_type = 'add_on_sale', {rev}, 0)) AS add_on_revenue")))


def _eligible(cust: DataFrame, cfg: KpiConfig) -> DataFrame:
    return (cust
            .filter((F.col("plan_type") == "basic")
                    & (F.col("tenure_days") >= cfg.upsell_min_tenure_days))
            .select("customer_id", "country", "segment", "plan_type", "mrr", "tenure_days"))


def eligible_customers(cust: DataFrame, subs: DataFrame,
                       cfg: KpiConfig = DEFAULT_CONFIG) -> DataFrame:
    """Basic-plan customers past the minimum tenure, one row per active subscription."""
    return (_eligible(cust, cfg)
            .join(subs.filter(F.col("is_active")).select("customer_id"), "customer_id", "inner"))


def upsold_customers(ups: DataFrame) -> DataFrame:
    return ups.select("customer_id").distinct()


def attach_rate_by_segment(cust: DataFrame, subs: DataFrame, ups: DataFrame,
                           cfg: KpiConfig = DEFAULT_CONFIG) -> DataFrame:
    """Eligible customers by market and segment, and the share already upsold.

    The aggregate over :func:`eligible_customers`, one row per active subscription,
    without building these rows: active subscriptions are counted per customer
    first, and a customer weighs as many rows as it has of them.  The left join to
    the distinct upsold ids is an existence flag; it never multiplies rows.
    """
    weight = (subs.filter("is_active AND customer_id IS NOT NULL").groupBy("customer_id")
              .agg(*sql_exprs("count(1) AS _w")))
    flagged = (_eligible(cust, cfg).join(weight, "customer_id", "inner")
               .join(upsold_customers(ups).withColumn("_upsold", F.lit(True)), "customer_id", "left"))
    total, upsold_n, base = "sum(_w)", "sum(IF(_upsold, _w, 0L))", "sum(mrr * _w)"
    return (flagged.groupBy("country", "segment")
            .agg(*sql_exprs(
                f"{total} AS eligible_count",
                f"{upsold_n} AS upsold_count",
                f"{round_ratio_sql(upsold_n, total, 2, 100)} AS upsell_attach_rate_pct",
                f"{base} AS eligible_mrr_base",
                f"CAST(CAST({base} AS DECIMAL(20,0)) * "
                f"{decimal_sql(cfg.upsell_opportunity_share)} AS DOUBLE) "
                "AS estimated_upsell_opportunity_mrr")))


MART_UPSELLING_COLUMNS = [
    ("record_type", "string"), ("month", "date"), ("country", "string"),
    ("upsell_type", "string"), ("sales_rep", "string"), ("upsell_count", "bigint"),
    ("total_incremental_revenue", "bigint"), ("avg_incremental_revenue", "double"),
    ("plan_upgrades", "bigint"), ("add_on_sales", "bigint"), ("upgrade_revenue", "bigint"),
    ("add_on_revenue", "bigint"), ("segment", "string"), ("eligible_count", "bigint"),
    ("upsold_count", "bigint"), ("upsell_attach_rate_pct", "double"),
    ("estimated_upsell_opportunity_mrr", "double"),
]


def mart_upselling(ups: DataFrame, cust: DataFrame, subs: DataFrame,
                   cfg: KpiConfig = DEFAULT_CONFIG) -> DataFrame:
    monthly = conform(monthly_upsell(ups), MART_UPSELLING_COLUMNS,
                      record_type="'monthly_upsell_performance'")
    attach = attach_rate_by_segment(cust, subs, ups, cfg)
    attach = conform(attach, MART_UPSELLING_COLUMNS,
                     record_type="'attach_rate_by_segment'",
                     upsell_count="upsold_count")
    return union_records([monthly, attach])


UPSELLING_ORDER = [("record_type", "asc", "last"), ("month", "desc", "last")]

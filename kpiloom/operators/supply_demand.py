"""Supply & demand: lead volume, assignment, conversion and SLA by market."""

from __future__ import annotations

from pyspark.sql import DataFrame

from kpiloom.config import DEFAULT_CONFIG, KpiConfig
from kpiloom.functions.kpi import month_start, round_ratio_sql, sql_exprs


def lead_metrics(leads: DataFrame, cfg: KpiConfig = DEFAULT_CONFIG) -> DataFrame:
    """One row per country × service × source × lead month (hash aggregate)."""
    total, converted = "count(1)", "count_if(is_converted)"
    assigned = "count_if(assigned_at IS NOT NULL)"
    breaches = f"count_if(hours_to_assign > {cfg.sla_hours})"
    return (leads
            .groupBy("country", "service_type", "lead_source",
                     month_start("lead_date").alias("month"))
            .agg(*sql_exprs(
                f"{total} AS total_leads",
                f"{converted} AS converted_leads",
                "count_if(lead_status = 'pending') AS pending_leads",
                "count_if(lead_status = 'unassigned') AS unassigned_leads",
                "count_if(lead_status = 'lost') AS lost_leads",
                f"{round_ratio_sql(converted, total, 2, 100)} AS conversion_rate_pct",
                f"{round_ratio_sql(assigned, total, 2, 100)} AS assignment_rate_pct",
                f"{round_ratio_sql('sum(hours_to_assign)', 'count(hours_to_assign)', 1)} "
                "AS avg_hours_to_assign",
                f"{round_ratio_sql('sum(days_to_convert)', 'count(days_to_convert)', 1)} "
                "AS avg_days_to_convert",
                f"{breaches} AS sla_breaches",
                f"{round_ratio_sql(breaches, assigned, 2, 100)} AS sla_breach_rate_pct")))


def mart_supply_demand(leads: DataFrame, cfg: KpiConfig = DEFAULT_CONFIG) -> DataFrame:
    """Lead metrics plus the unassigned share and the supply-gap flag (> 10 %)."""
    return lead_metrics(leads, cfg).selectExpr(
        "*",
        f"{round_ratio_sql('unassigned_leads', 'total_leads', 2, 100)} AS unassigned_rate_pct",
        # share > 1/10, compared exactly in integers
        f"CASE WHEN total_leads <> 0 THEN unassigned_leads * "
        f"{cfg.supply_gap_share_denominator} > total_leads END AS has_supply_gap")


# Presentation order; nulls sort high, as in the source warehouse.
SUPPLY_DEMAND_ORDER = [("month", "desc", "first"), ("country", "asc", "last"),
                       ("service_type", "asc", "last")]

"""Customer satisfaction: NPS/CSAT by month, detractor detail, response rate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.kpi import month_start, round_ratio_sql, sql_exprs
from kpiloom.operators.joins import DEFAULT_HOT_ROWS, fanout_join, hot_keys
from kpiloom.operators.union import conform, union_records


def _surveys_with_customer(surv: DataFrame, cust: DataFrame) -> DataFrame:
    return (surv.select("survey_id", "customer_id", "survey_date", "nps_score", "csat_score",
                        "nps_category", "is_satisfied", "comment")
            .join(cust.select("customer_id", "customer_name", "country", "segment",
                              "plan_type", "mrr"), "customer_id", "left"))


def enriched_surveys(surv: DataFrame, cust: DataFrame, subs: DataFrame,
                     hot: DataFrame = None, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Surveys ⟕ customers ⟕ active subscriptions.

    Market, segment, plan and MRR come from the customer; ``is_active`` is true
    or null, and a survey repeats once per active subscription of its customer, a
    many-to-many join in which the customers of ``hot`` (counts ``n_surveys`` and
    ``n_active``) are split.
    """
    key = "customer_id"
    active = subs.filter(F.col("is_active")).select(key, "is_active")
    grid = None if hot is None else hot_keys(hot, key, "n_surveys", "n_active", hot_rows)
    return (fanout_join(_surveys_with_customer(surv, cust), active, key, "left", grid, hot_rows)
            .select("survey_id", "customer_id", "survey_date", "nps_score", "csat_score",
                    "nps_category", "is_satisfied", "comment", "customer_name", "country",
                    "segment", "plan_type", "mrr", "is_active"))


def nps_monthly(surv: DataFrame, cust: DataFrame, subs: DataFrame) -> DataFrame:
    """NPS / CSAT per survey month × customer market, segment and plan.

    The result is the aggregate of :func:`enriched_surveys` (where a survey
    counts once per active subscription of its customer), computed without
    building that fan-out: surveys are first rolled up per (customer, month) —
    partial aggregation collapses a hot customer to one row per month — then
    each rollup row meets its customer and its active-subscription count ``w``
    once, and every measure is summed with weight ``w``.
    """
    key = "customer_id"
    rollup = (surv.groupBy(key, month_start("survey_date").alias("month"))
              .agg(*sql_exprs(
                  "count(1) AS _n",
                  "count_if(nps_category = 'promoter') AS _prom",
                  "count_if(nps_category = 'passive') AS _pas",
                  "count_if(nps_category = 'detractor') AS _det",
                  "count_if(is_satisfied) AS _sat",
                  "sum(nps_score) AS _nps", "count(nps_score) AS _nps_n",
                  "sum(csat_score) AS _csat", "count(csat_score) AS _csat_n")))
    weight = subs.filter("is_active").groupBy(key).agg(*sql_exprs("count(1) AS _w"))
    rows = (rollup
            .join(cust.select(key, "country", "segment", "plan_type", "mrr"), key, "left")
            .join(weight, key, "left"))
    w = "COALESCE(_w, 1L)"
    responses = f"sum(_n * {w})"
    return (rows.groupBy("month", "country", "segment", "plan_type")
            .agg(*sql_exprs(
                f"{responses} AS survey_responses",
                f"sum(_prom * {w}) AS promoters",
                f"sum(_pas * {w}) AS passives",
                f"sum(_det * {w}) AS detractors",
                f"{round_ratio_sql(f'sum((_prom - _det) * {w})', responses, 1, 100)} "
                "AS nps_score",
                f"{round_ratio_sql(f'sum(_sat * {w})', responses, 1, 100)} AS csat_pct",
                f"{round_ratio_sql(f'sum(_nps * {w})', f'sum(_nps_n * {w})', 2)} AS avg_nps_raw",
                f"{round_ratio_sql(f'sum(_csat * {w})', f'sum(_csat_n * {w})', 2)} "
                "AS avg_csat_raw",
                # sum(iff(detractor, mrr, 0)) over the weighted rows: null only when
                # every contributing row is a detractor with a null MRR
                f"CASE WHEN count_if(_n > _det OR mrr IS NOT NULL) > 0 "
                f"THEN COALESCE(sum(_det * {w} * mrr), 0L) END AS detractor_mrr_at_risk",
                f"sum(_n * {w} * mrr) AS total_surveyed_mrr")))


def detractor_detail(surv: DataFrame, cust: DataFrame, subs: DataFrame,
                     hot: DataFrame = None, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Detractor responses; ``is_active_detractor`` is true or null (three-valued).

    The detractor filter reads a survey column, so it runs before the joins
    and only detractor surveys take part in the fan-out.
    """
    detractors = surv.filter(F.col("nps_category") == "detractor")
    return detractor_rows(enriched_surveys(detractors, cust, subs, hot, hot_rows))


def detractor_rows(enriched: DataFrame) -> DataFrame:
    detractor = F.col("nps_category") == "detractor"
    return (enriched.filter(detractor)
            .select("customer_id", "customer_name", "country", "segment", "plan_type", "mrr",
                    "nps_score", "csat_score", "survey_date", "comment", "is_active",
                    (detractor & F.col("is_active")).alias("is_active_detractor")))


def response_rate(cust: DataFrame, surv: DataFrame) -> DataFrame:
    """Distinct surveyed customers over distinct customers, by survey-side market.

    A survey's market is its customer's market, so a customer row lands in its
    own market when its id has any survey, and in the null market otherwise
    (with duplicated customer ids this still gives each id the markets of all
    its rows, as the row-level join does).  Both sides are reduced to distinct
    rows before the join, map-side first, so neither many surveys nor many rows
    of one customer reach it, and the distinct (market, customer, surveyed) rows
    then count with plain counts.
    """
    surveyed = (surv.filter("customer_id IS NOT NULL").select("customer_id").distinct()
                .selectExpr("customer_id", "true AS _surveyed"))
    rows = (cust.select("customer_id", "country").distinct().join(surveyed, "customer_id", "left")
            .selectExpr("IF(_surveyed, country, NULL) AS country", "customer_id",
                        "IF(_surveyed, customer_id, NULL) AS _sv_id")
            .distinct())
    surveyed_n, customers_n = "count(_sv_id)", "count(customer_id)"
    return (rows.groupBy("country")
            .agg(*sql_exprs(
                f"{surveyed_n} AS surveyed_customers",
                f"{customers_n} AS active_customers",
                f"{round_ratio_sql(surveyed_n, customers_n, 1, 100)} AS response_rate_pct")))


MART_SATISFACTION_COLUMNS = [
    ("record_type", "string"), ("month", "date"), ("country", "string"),
    ("segment", "string"), ("plan_type", "string"), ("survey_responses", "bigint"),
    ("promoters", "bigint"), ("passives", "bigint"), ("detractors", "bigint"),
    ("nps_score", "double"), ("csat_pct", "double"), ("avg_nps_raw", "double"),
    ("avg_csat_raw", "double"), ("detractor_mrr_at_risk", "bigint"),
    ("total_surveyed_mrr", "bigint"), ("customer_id", "string"), ("customer_name", "string"),
    ("mrr", "bigint"), ("nps_score_raw", "bigint"), ("csat_score_raw", "bigint"),
    ("comment", "string"), ("is_active", "boolean"), ("is_active_detractor", "boolean"),
    ("surveyed_customers", "bigint"), ("active_customers", "bigint"),
    ("response_rate_pct", "double"),
]


def mart_customer_satisfaction(surv: DataFrame, cust: DataFrame, subs: DataFrame,
                               hot: DataFrame = None, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    monthly = conform(nps_monthly(surv, cust, subs), MART_SATISFACTION_COLUMNS,
                      record_type="'nps_monthly'")
    detail = conform(detractor_detail(surv, cust, subs, hot, hot_rows), MART_SATISFACTION_COLUMNS,
                     record_type="'detractor_detail'", detractor_mrr_at_risk="mrr",
                     total_surveyed_mrr="mrr", nps_score_raw="nps_score",
                     csat_score_raw="csat_score", nps_score="NULL")
    rate = conform(response_rate(cust, surv), MART_SATISFACTION_COLUMNS,
                   record_type="'response_rate'",
                   survey_responses="surveyed_customers")
    return union_records([monthly, detail, rate])


SATISFACTION_ORDER = [("record_type", "asc", "last"), ("month", "desc", "last")]

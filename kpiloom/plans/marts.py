"""End-to-end plans: sources → staging → the six marts, checks and sinks."""

from __future__ import annotations

from typing import Dict, Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.config import DEFAULT_CONFIG, KpiConfig
from kpiloom.operators import (
    churn, debt, partners, quality, satisfaction, staging, supply_demand, upselling,
)
from kpiloom.operators.joins import DEFAULT_HOT_ROWS, side_counts
from kpiloom.operators.ordering import full_order, sort_columns, with_position
from kpiloom.sources.io import register, write_mart
from kpiloom.sources.published import publish, read_published, refresh

MART_NAMES = ("mart_supply_demand", "mart_churn", "mart_upselling", "mart_roi_partnerships",
              "mart_debt_collection", "mart_customer_satisfaction")

STAGING_NAMES = {"stg_customers": "cust", "stg_subscriptions": "subs", "stg_leads": "leads",
                 "stg_invoices": "inv", "stg_partners": "part", "stg_nps_surveys": "surv",
                 "stg_upsell_events": "ups"}

# Presentation order of each mart (applied only when a sorted output is asked for).
MART_ORDER = {
    "mart_supply_demand": supply_demand.SUPPLY_DEMAND_ORDER,
    "mart_churn": churn.CHURN_ORDER,
    "mart_upselling": upselling.UPSELLING_ORDER,
    "mart_roi_partnerships": partners.ROI_ORDER,
    "mart_debt_collection": debt.DEBT_ORDER,
    "mart_customer_satisfaction": satisfaction.SATISFACTION_ORDER,
}


def find_hot_customers(st: Dict[str, DataFrame], path: str,
                       hot_rows: int = DEFAULT_HOT_ROWS) -> Optional[DataFrame]:
    """The customers whose joins need splitting, found in one pass over the narrow
    key columns of the staged tables and saved at ``path`` (shared storage).

    One row per customer with more than ``hot_rows`` active subscriptions, surveys
    or overdue invoices, or pairs of the first two: ``n_active``, ``n_surveys``,
    ``n_overdue``. None if there is no such customer, as in most data.
    """
    counts = side_counts("customer_id", n_active=st["subs"].filter("is_active"),
                         n_surveys=st["surv"], n_overdue=st["inv"].filter("is_currently_overdue"))
    write_mart(counts.filter(f"greatest(n_surveys, n_overdue, n_active * greatest(n_surveys, 1)) > {hot_rows}"),
               path=path)
    hot = counts.sparkSession.read.schema(counts.schema).parquet(path)
    return None if hot.isEmpty() else hot


def build_mart(name: str, st: Dict[str, DataFrame], cfg: KpiConfig = DEFAULT_CONFIG,
               as_of=None, hot: Optional[DataFrame] = None,
               hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """One mart from staged frames (keys as in :func:`staging.stage_all`).  ``hot``
    are the customers to split (:func:`find_hot_customers`); None joins plainly."""
    if name == "mart_supply_demand":
        return supply_demand.mart_supply_demand(st["leads"], cfg)
    if name == "mart_churn":
        return churn.mart_churn(st["cust"], st["subs"], st["surv"], st["inv"], cfg, as_of,
                                hot, hot_rows)
    if name == "mart_upselling":
        return upselling.mart_upselling(st["ups"], st["cust"], st["subs"], cfg)
    if name == "mart_roi_partnerships":
        return partners.mart_roi_partnerships(st["part"], st["cust"], st["subs"],
                                              st["leads"], as_of)
    if name == "mart_debt_collection":
        return debt.mart_debt_collection(st["inv"], st["cust"])
    if name == "mart_customer_satisfaction":
        return satisfaction.mart_customer_satisfaction(st["surv"], st["cust"], st["subs"],
                                                       hot, hot_rows)
    raise KeyError(name)


def build_marts(sources: Dict[str, DataFrame], cfg: KpiConfig = DEFAULT_CONFIG,
                as_of=None, hot: Optional[DataFrame] = None,
                hot_rows: int = DEFAULT_HOT_ROWS) -> Dict[str, DataFrame]:
    """All six marts as lazy DataFrames (nothing runs until an action)."""
    st = staging.stage_all(sources, cfg, as_of)
    return {name: build_mart(name, st, cfg, as_of, hot, hot_rows) for name in MART_NAMES}


def register_models(frames: Dict[str, DataFrame]) -> Dict[str, DataFrame]:
    """Expose frames as SQL temporary views under their model names
    (``stg_customers`` … ``mart_customer_satisfaction``), as the staging views
    and mart tables are addressed in SQL."""
    for name, df in frames.items():
        register(df, name)
    return frames


def present(df: DataFrame, mart: str) -> DataFrame:
    """The mart in its presentation order (a global range-partitioned sort).

    The declared order leaves ties unordered, and its keys have few distinct
    values (e.g. every at-risk row shares record type, month and one of three
    risk levels), which a range partitioner cannot split.  The remaining
    columns are appended as tiebreakers, so ties spread over partitions while
    the declared order is kept.
    """
    return df.orderBy(*sort_columns(full_order(df, MART_ORDER[mart])))


def present_numbered(df: DataFrame, mart: str) -> DataFrame:
    """The mart and each row's ``position`` in its presentation order, for consumers that
    page through it or read it back from files, which keep no order."""
    return with_position(df, MART_ORDER[mart])


def model_frames(sources: Dict[str, DataFrame], cfg: KpiConfig = DEFAULT_CONFIG,
                 as_of=None, marts: Optional[Dict[str, DataFrame]] = None) -> Dict[str, DataFrame]:
    """Staging and mart frames keyed by model name, for the quality suite."""
    st = staging.stage_all(sources, cfg, as_of)
    frames = {model: st[key] for model, key in STAGING_NAMES.items()}
    if marts is None:
        marts = {name: build_mart(name, st, cfg, as_of) for name in MART_NAMES}
    frames.update(marts)
    return frames


def quality_report(sources: Dict[str, DataFrame], cfg: KpiConfig = DEFAULT_CONFIG,
                   as_of=None, marts: Optional[Dict[str, DataFrame]] = None,
                   checks=None) -> DataFrame:
    """All 68 declared checks → ``(model, column_name, check_name, failures)``."""
    frames = model_frames(sources, cfg, as_of, marts)
    return quality.run_checks(frames, checks if checks is not None else quality.ALL_CHECKS)


def build_and_write(spark: SparkSession, sources: Dict[str, DataFrame],
                    out_dir: str, cfg: KpiConfig = DEFAULT_CONFIG,
                    as_of=None, run_checks: bool = True,
                    hot_rows: int = DEFAULT_HOT_ROWS) -> Optional[DataFrame]:
    """Full refresh: publish every mart under ``out_dir``, then check the published tables.

    ``out_dir`` is on storage that all executors share; marts are read back with
    :func:`kpiloom.sources.published.read_published`, and stay as they were published
    before until their new version is complete.  Hot customers are found first, once
    for all marts.  The marts are checked from their written copies, so the quality
    suite does not recompute any mart and a lost executor only re-runs from the files.
    """
    st = staging.stage_all(sources, cfg, as_of)
    hot = find_hot_customers(st, f"{out_dir}/hot_customers", hot_rows)
    for name in MART_NAMES:
        publish(build_mart(name, st, cfg, as_of, hot, hot_rows), f"{out_dir}/{name}")
    if not run_checks:
        return None
    written = {name: read_published(spark, f"{out_dir}/{name}") for name in MART_NAMES}
    report = quality_report(sources, cfg, as_of, marts=written)
    publish(report, f"{out_dir}/quality_report")
    return read_published(spark, f"{out_dir}/quality_report")


def refresh_months(mart: DataFrame, path: str, months) -> int:
    """Publish the rows of ``months`` (dates, or None for rows without one) of a mart anew;
    the months are filtered before the mart's own work where its plan allows it, and the
    files of all other months stay as they are."""
    days = [m for m in months if m is not None]
    keep = F.col("month").isin(days) if days else F.lit(False)
    if None in months:
        keep = keep | F.col("month").isNull()
    return refresh(mart.filter(keep), path, months)

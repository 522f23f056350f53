"""Month spine: one row per month from a start date, end date exclusive."""

from __future__ import annotations

import datetime as _dt
from typing import Union

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.functions.kpi import as_of_column, month_diff


def month_spine(bounds: DataFrame, start: str = "start_date", end: str = "end_date",
                out: str = "date_month") -> DataFrame:
    """Expand each (start, end) row of ``bounds`` into its month spine.

    The spine has ``month_diff(start, end)`` rows: ``start + n months`` for
    ``n = 0 …`` (day of month clamped, as calendar month addition does), so the
    end month itself is excluded.  Other columns of ``bounds`` are kept.
    """
    n = month_diff(F.col(start), F.col(end))
    offsets = F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1))
    return (bounds
            .withColumn("_spine_n", F.explode(offsets))
            .withColumn(out, F.add_months(F.col(start), F.col("_spine_n").cast("int")))
            .filter(F.col(out) <= F.col(end))
            .drop("_spine_n"))


def date_spine_months(spark: SparkSession, start: Union[_dt.date, str, Column],
                      end: Union[_dt.date, str, Column]) -> DataFrame:
    """Month spine between two literal dates: column ``date_month``."""
    bounds = spark.range(1).select(as_of_column(start).alias("start_date"),
                                   as_of_column(end).alias("end_date"))
    return month_spine(bounds).select("date_month")

"""kpiloom — subscription-marketplace KPI marts as Spark DataFrame plans.

Every operator is a pure function from DataFrames to a DataFrame built from
built-in Spark functions and SQL expressions; nothing is collected to the
driver.  Main entry points::

    from kpiloom import build_marts, build_and_write, present, read_sources
"""

from kpiloom.config import DEFAULT_AS_OF, KpiConfig
from kpiloom.plans.marts import (
    MART_NAMES, build_and_write, build_marts, present, quality_report, register_models,
)
from kpiloom.sources import read_source, read_sources, write_mart

__all__ = [
    "DEFAULT_AS_OF", "KpiConfig", "MART_NAMES", "build_and_write", "build_marts", "present",
    "quality_report", "read_source", "read_sources", "register_models", "write_mart",
]

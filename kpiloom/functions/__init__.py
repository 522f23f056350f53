"""KPI column functions (rates, buckets, classifications, date maths)."""

from kpiloom.functions.kpi import (
    aging_bucket, as_of_column, blank_to_null, classify_nps, day_diff,
    month_diff, month_start, nps_score, pct, region_of,
    round_ratio, safe_divide, to_date, typed_null,
)
from kpiloom.functions.spine import date_spine_months, month_spine

__all__ = [
    "aging_bucket", "as_of_column", "blank_to_null", "classify_nps", "date_spine_months",
    "day_diff", "month_diff", "month_spine", "month_start",
    "nps_score", "pct", "region_of", "round_ratio", "safe_divide", "to_date",
    "typed_null",
]

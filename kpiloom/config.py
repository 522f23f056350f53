"""Run parameters shared by the staging and mart operators."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

# The date every fixture, oracle comparison and benchmark is pinned to.  The
# operators themselves take ``as_of=None`` to mean today, as the models do.
DEFAULT_AS_OF = _dt.date(2024, 4, 1)


@dataclass(frozen=True)
class KpiConfig:
    """Business thresholds (the three project variables the models read).

    ``upsell_min_tenure_days`` is both the upsell eligibility threshold and the
    "new subscription" bonus in the churn risk score.
    """

    upsell_min_tenure_days: int = 30
    nps_low_score: int = 6
    nps_high_score: int = 9
    # Fixed value: the passive/detractor cut is a constant, not a variable.
    nps_passive_score: int = 7
    # Fixed value: share of the eligible MRR base counted as upsell opportunity.
    upsell_opportunity_share: str = "0.9"
    # Fixed value: assignment SLA in hours.
    sla_hours: int = 24
    # Fixed value: unassigned share above which a market has a supply gap (1/10).
    supply_gap_share_denominator: int = 10


DEFAULT_CONFIG = KpiConfig()

"""All dates and thresholds the operators use, in one frozen dataclass.

Defaults are the values the reference hard-codes; ``Params.fixture()`` holds
the values that make every label occur on the provided test tables
(whose orders span 1995-01-01 .. 2001-08-01).
"""

from __future__ import annotations

import dataclasses
import datetime as dt

D = dt.date


@dataclasses.dataclass(frozen=True)
class Params:
    # leave the heal's ghost customer out of country AOV, signups, LTV and RFM (q04, q05, q06, q24)
    exclude_ghost: bool = False
    # q01 revenue range [start, end)
    q01_start: dt.date = D(2024, 1, 1)
    q01_end: dt.date = D(2025, 1, 1)
    # q09 churn
    q09_ref: dt.date = D(2025, 1, 1)
    q09_days: int = 90
    # q10 spend tiers
    q10_gold: int = 20000
    q10_silver: int = 10000
    # q11 / b18 low stock
    low_stock: int = 20
    # q13 no recent sales
    q13_ref: dt.date = D(2024, 12, 30)
    q13_days: int = 30
    # q21 cohorts: (label, start, end) and activity window
    q21_ref: dt.date = D(2024, 12, 31)
    q21_days: int = 30
    q21_cohorts: tuple = (("Q1 2024", D(2024, 1, 1), D(2024, 4, 1)),
                          ("Q2 2024", D(2024, 4, 1), D(2024, 7, 1)))
    # q22 product status
    q22_hot: int = 50
    q22_moderate: int = 10
    # q24 RFM
    q24_ref: dt.date = D(2024, 12, 31)
    q24_recent_days: int = 15
    q24_lapsed_days: int = 30
    q24_freq_high: int = 5
    q24_freq_mid: int = 3
    q24_spend: int = 12000
    # q27 lifecycle
    q27_ref: dt.date = D(2024, 12, 31)
    q27_months: int = 3
    # dq_k "today"
    dq_as_of: dt.date = D(2026, 3, 1)
    # brief
    brief_as_of: dt.date = D(2026, 3, 1)
    brief_champ_days: int = 15
    brief_champ_freq: int = 2
    brief_risk_days: int = 30
    brief_risk_freq: int = 1
    brief_churn_days: int = 90
    brief_active_days: int = 30
    brief_retention_days: int = 30
    brief_dead_days: int = 30
    brief_hot_units: int = 50
    brief_launch_days: int = 90
    # alerts
    alert_as_of: dt.date = D(2026, 3, 1)
    alert_window_days: int = 30
    alert_cap: int = 10
    # healing
    ghost_customer_id: int = -1
    ghost_signup: dt.date = D(2026, 3, 1)

    @staticmethod
    def fixture() -> "Params":
        """Test values for the provided tables (every label occurs on sf0.01)."""
        return Params(
            q01_start=D(2000, 1, 1), q01_end=D(2001, 1, 1),
            q09_ref=D(2001, 8, 1), q09_days=90,
            q10_gold=2_500_000, q10_silver=1_500_000,
            q13_ref=D(2001, 7, 31), q13_days=30,
            q21_ref=D(2001, 7, 31), q21_days=30,
            q21_cohorts=(("Q1 2001", D(2001, 1, 1), D(2001, 4, 1)),
                         ("Q2 2001", D(2001, 4, 1), D(2001, 7, 1))),
            q22_hot=800, q22_moderate=600,
            q24_ref=D(2001, 7, 31), q24_spend=2_000_000,
            q27_ref=D(2001, 7, 31),
            dq_as_of=D(2001, 7, 15),
            brief_as_of=D(2001, 7, 31), brief_hot_units=800,
            alert_as_of=D(2024, 1, 28),
            ghost_signup=D(2001, 7, 31),
        )

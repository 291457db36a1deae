"""Run parameters.

The warehouse scripts read ``CURRENT_DATE()`` / ``CURRENT_TIMESTAMP()`` and a
handful of script variables. Here they are explicit, frozen values so every
output is reproducible and can be checked against an independent engine.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Params:
    as_of: dt.date = field(default_factory=dt.date.today)
    run_ts: dt.datetime | None = None       # None: midnight of ``as_of``
    # Vendors treated as "our own brand": excluded from forecasting and restock.
    internal_vendors: tuple[str, ...] = ()

    # ---- lookbacks (days) ----
    sales_lookback_days: int = 365          # sales_daily / training window
    retention_days: int = 365               # partition expiry
    snapshot_lookback_days: int = 30        # restock / negative-stock latest snapshot
    readiness_lookback_days: int = 365      # latest snapshot count check
    freshness_lookback_days: int = 7        # sales_daily freshness check
    vendor_rank_months: int = 6             # vendor revenue ranking window

    # ---- vendor defaults / cadence ----
    default_lead_time_days: int = 5
    default_moq: int = 6
    default_pack_size: int = 6
    fast_cadence_top_n: int = 8
    fast_cadence_days: int = 7
    slow_cadence_days: int = 14

    # ---- backtest ----
    holdout_weeks: int = 4
    holdout_inclusive: bool = True          # Q1: holdout [cutoff, last] = 5 weeks; False = the 4 forecast weeks
    train_weeks: int = 52
    min_holdout_units: int = 4
    good_wape: float = 0.60
    weak_wape: float = 0.80
    bad_wape: float = 1.00

    # ---- forecast / restock ----
    forecast_horizon_days: int = 60
    confidence_level: float = 0.95
    review_days: int = 7
    safety_days: int = 3
    fallback_days: int = 56
    cadence_days: int = 7
    stockout_from_as_of: bool = False       # Q9: False counts every forecast day, even before as_of

    def __post_init__(self) -> None:
        if self.run_ts is None:
            object.__setattr__(self, "run_ts", dt.datetime.combine(self.as_of, dt.time()))

    # ---- derived dates (the script variables) ----
    @property
    def last_complete_week_start(self) -> dt.date:
        """Monday of the week containing ``as_of - 7 days``."""
        d = self.as_of - dt.timedelta(days=7)
        return d - dt.timedelta(days=d.weekday())

    @property
    def cutoff_week_start(self) -> dt.date:
        return self.last_complete_week_start - dt.timedelta(weeks=self.holdout_weeks)

    @property
    def holdout_end_week(self) -> dt.date:
        """Last holdout week: the last complete week, or (strict) the 4th forecast week."""
        if self.holdout_inclusive:
            return self.last_complete_week_start
        return self.cutoff_week_start + dt.timedelta(weeks=self.holdout_weeks - 1)

    @property
    def train_start_week(self) -> dt.date:
        return self.last_complete_week_start - dt.timedelta(weeks=self.train_weeks)

    def days_ago(self, n: int) -> dt.date:
        return self.as_of - dt.timedelta(days=n)

    def months_ago(self, n: int) -> dt.date:
        """``as_of - INTERVAL n MONTH`` with end-of-month clamping."""
        y, m = self.as_of.year, self.as_of.month - n
        while m <= 0:
            y, m = y - 1, m + 12
        import calendar

        last = calendar.monthrange(y, m)[1]
        return dt.date(y, m, min(self.as_of.day, last))

    @property
    def z_value(self) -> float:
        """Two-sided normal quantile for ``confidence_level``."""
        from statistics import NormalDist

        return NormalDist().inv_cdf(0.5 + self.confidence_level / 2.0)


DEFAULT_PARAMS = Params()

"""Forecast horizon: every date constant of a run, passed as one argument."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Horizon:
    train_from: _dt.date = _dt.date(1996, 1, 1)
    val_start: _dt.date = _dt.date(1999, 10, 1)
    val_end: _dt.date = _dt.date(1999, 12, 31)
    test_start: _dt.date = _dt.date(2000, 10, 1)
    test_end: _dt.date = _dt.date(2000, 12, 31)
    season_months: tuple[int, ...] = (10, 11, 12)
    # store growth: CAGR from the first to the last full training year
    growth_first_year: int = 1996
    growth_last_year: int = 1999
    # season trend: this year's season vs all earlier seasons
    trend_year: int = 1999
    # fitted aggregates use rows with date < fit_until; None = test_start (parity)
    fit_until: _dt.date | None = None

    @property
    def fit_end(self) -> _dt.date:
        return self.fit_until or self.test_start

    @property
    def panel_end(self) -> _dt.date:
        """Exclusive end of the panel (day after the test quarter)."""
        return self.test_end + _dt.timedelta(days=1)

    def honest(self) -> "Horizon":
        """Fit aggregates before the validation season (no in-sample val)."""
        return replace(self, fit_until=self.val_start)


DEFAULT = Horizon()

"""The input tables of the feature plans and the calendar they live in."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Calendar:
    """Dates that a caller sets for a panel.

    cutoff: first unlabelled date.  start: first date of the feature rows,
    after the warm-up in which windows are short.  month_days: days of a
    forecast month.  horizons: forecast months.
    """

    cutoff: dt.date
    start: dt.date
    month_days: int = 28
    horizons: tuple[int, ...] = tuple(range(1, 11))

    def end_date(self, horizon: int) -> dt.date:
        """Last future date that the feature set of ``horizon`` sees."""
        return self.cutoff + dt.timedelta(days=self.month_days * horizon)


@dataclass(frozen=True)
class PanelTables:
    history: DataFrame
    future: DataFrame
    stores: DataFrame
    context: DataFrame
    calendar: Calendar

"""Report parameters: the period, its cutoff, and the default periods."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


def as_date(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value).strip())


@dataclass(frozen=True)
class ReportParams:
    """Inclusive delivery-date period ``[start, end]`` and the customer cutoff.

    ``cutoff`` defaults to ``start`` (with that default the new-customer
    HAVING never removes a row; pass an earlier ``start`` for a real
    new-customer window).  Strings in ISO form are accepted and validated.
    """

    start: dt.date
    end: dt.date
    cutoff: dt.date | None = None

    def __post_init__(self):
        object.__setattr__(self, "start", as_date(self.start))
        object.__setattr__(self, "end", as_date(self.end))
        object.__setattr__(self, "cutoff", as_date(self.cutoff) if self.cutoff else self.start)
        if self.end < self.start:
            raise ValueError(f"period ends before it starts: {self.start} > {self.end}")

    @property
    def label(self) -> str:
        """``<start>_to_<end>``, used in output names."""
        return f"{self.start.isoformat()}_to_{self.end.isoformat()}"


def last_n_days(today=None, n: int = 7) -> ReportParams:
    """``start = today - n days``, ``end = today``, cutoff = start.

    With the inclusive period filter this spans ``n + 1`` calendar days.
    """
    today = as_date(today) if today is not None else dt.date.today()
    start = today - dt.timedelta(days=n)
    return ReportParams(start, today, start)


def yesterday(today=None) -> dt.date:
    """The day before ``today`` (default report day of the daily detail)."""
    today = as_date(today) if today is not None else dt.date.today()
    return today - dt.timedelta(days=1)


def day_list(start, end) -> list[dt.date]:
    """Every day from ``start`` to ``end`` inclusive, for labels and paths only."""
    start, end = as_date(start), as_date(end)
    if end < start:
        raise ValueError(f"range ends before it starts: {start} > {end}")
    return [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]

"""Row predicates of the reports, as Columns.

Deny-lists follow SQL ``NOT IN``: a NULL value is dropped, not kept.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordertally.params import ReportParams, as_date

# Fixed status and store codes used by the reports.
CANCELLED_STATUSES = (4, 11)
NEW_CUSTOMER_EXCLUDED_STATUSES = (4, 11, 1)
DAILY_STATUSES = (0, 3, 7)
EXCLUDED_STORES = (84, 85)
MISSING_LINES_EXCLUDED_STORES = (82, 84, 85)
ZONE_EXCLUDED_STORES = (84,)


def _day(value) -> Column:
    return F.lit(as_date(value))


def in_period(p: ReportParams, c: str = "delivery_date") -> Column:
    """``c BETWEEN start AND end`` (both ends included)."""
    return F.col(c).between(_day(p.start), _day(p.end))


def on_day(day, c: str = "delivery_date") -> Column:
    return F.col(c) == _day(day)


def status_in(*codes: int, c: str = "status") -> Column:
    return F.col(c).isin(list(codes))


def status_not_in(*codes: int, c: str = "status") -> Column:
    return ~F.col(c).isin(list(codes))


def exclude_stores(*ids: int, c: str = "store_id") -> Column:
    return ~F.col(c).isin(list(ids))


def window_in(*windows: int, c: str = "delivery_window") -> Column:
    return F.col(c).isin(list(windows))


def non_empty(c: str) -> Column:
    """``c != ''``: drops both empty strings and NULL."""
    return F.col(c) != F.lit("")


def daily_rows(day, strict_status: bool = False) -> Column:
    """Orders of one daily-totals day.

    Literal reading of the source condition
    ``(date = D AND window = 1) OR (date = D+1 AND window = 0) AND status IN (0,3,7)``:
    AND binds tighter, so the status test applies to the window-0 branch only.
    ``strict_status=True`` applies it to both branches.
    """
    d = as_date(day)
    evening = on_day(d) & (F.col("delivery_window") == 1)
    morning = on_day(d + dt.timedelta(days=1)) & (F.col("delivery_window") == 0)
    ok = status_in(*DAILY_STATUSES)
    if strict_status:
        return (evening & ok) | (morning & ok)
    return evening | (morning & ok)


def report_day(strict_status: bool = False) -> Column:
    """The daily-totals day an order belongs to, or NULL.

    Window-1 orders count on their delivery day, window-0 orders on the day
    before.  Each order maps to at most one day, which turns the per-day
    query loop into one grouped pass over the whole range.
    """
    ok = status_in(*DAILY_STATUSES)
    w = F.col("delivery_window")
    evening = (w == 1) & ok if strict_status else (w == 1)
    return (
        F.when(evening, F.col("delivery_date"))
        .when((w == 0) & ok, F.date_sub(F.col("delivery_date"), 1))
    )

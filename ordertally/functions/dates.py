"""Date expressions: day parsing, range splitting, date spines and next day.

All are Column expressions (JVM-side, codegen), so they run inside the scan
stage over any number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertally.params import as_date

# Fixed input formats of a report day, tried in this order:
# day-month-two-digit-year undelimited, with dots, with slashes.
DAY_FORMATS = ("ddMMyy", "d.M.yy", "d/M/yy")
# Undelimited digits: day and month may have one digit where the rest still fits.
DAY_DIGITS = r"^(3[01]|[12][0-9]|0[1-9]|[1-9])(1[0-2]|0[1-9]|[1-9])([0-9]{2})"

# Fixed two-digit-year pivot: years 69..99 are 1969..1999, 00..68 are 2000..2068.
PIVOT_YEAR = 2069


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_day(c) -> Column:
    """Parse a day written as ``ddMMyy``, ``d.M.yy`` or ``d/M/yy``; NULL if none fits.

    Surrounding white space is ignored.  Undelimited text may leave out
    leading zeros (``11125`` is 11.1.25).  Two-digit years follow the common
    pivot (``75`` is 1975, ``25`` is 2025) rather than Spark's 2000-based one.
    """
    text = F.regexp_replace(_col(c), r"^\s+|\s+$", "")
    day, month, year = (F.regexp_extract(text, DAY_DIGITS, i) for i in (1, 2, 3))
    digits = F.when(F.concat(day, month, year) == text, F.concat_ws(".", day, month, year))
    parsed = F.coalesce(F.try_to_date(digits, DAY_FORMATS[1]), *[F.try_to_date(text, fmt) for fmt in DAY_FORMATS[1:]])
    return F.when(F.year(parsed) >= PIVOT_YEAR, F.add_months(parsed, -1200)).otherwise(parsed)


def parse_range(c) -> tuple[Column, Column]:
    """Split ``a-b`` into (start, end) days; a single day gives start = end.

    Parts after the second ``-`` are ignored.
    """
    parts = F.split(_col(c), "-")
    first = F.get(parts, 0)
    second = F.coalesce(F.get(parts, 1), first)
    return parse_day(first), parse_day(second)


def last_n_days_cols(today, n: int = 7) -> tuple[Column, Column]:
    """Column form of ``params.last_n_days``: ``(today - n, today)``."""
    today = _col(today)
    return F.date_sub(today, n), today


def next_day(c) -> Column:
    return F.date_add(_col(c), 1)


def format_day(c) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd")


def date_spine(spark: SparkSession, start, end, name: str = "report_date") -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive.

    The row count is the number of days, so this frame has a known small
    size bound.  A reversed range raises ``ValueError``.
    """
    s, e = as_date(start), as_date(end)
    if e < s:
        raise ValueError(f"range ends before it starts: {s} > {e}")
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(s), F.lit(e), F.expr("INTERVAL 1 DAY"))).alias(name)
    )


def spine_between(bounds: DataFrame, lo: str, hi: str, name: str = "report_date") -> DataFrame:
    """Day rows between two date columns of each row of ``bounds`` (inclusive)."""
    return bounds.select(
        F.explode(F.sequence(F.col(lo), F.col(hi), F.expr("INTERVAL 1 DAY"))).alias(name)
    )

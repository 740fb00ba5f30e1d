"""Aggregate expressions with fixed, engine-independent result types.

Money sums are DECIMAL(18,2), averages DOUBLE computed as ``sum / count`` so
every engine returns the same bits.  Quantity sums follow the quantities:
BIGINT for whole numbers, DECIMAL with three places for weights.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY_TOTAL = T.DecimalType(18, 2)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def line_value(qty, price) -> Column:
    """``qty * price`` in exact decimal arithmetic."""
    return _col(qty) * _col(price)


def missing_quantity(needed="quantity_needed", packed="quantity") -> Column:
    """Units ordered but not packed: ``needed - packed``."""
    return _col(needed) - _col(packed)


def money_sum(c) -> Column:
    return F.sum(_col(c)).cast(MONEY_TOTAL)


def qty_sum(c) -> Column:
    """Exact sum; BIGINT of whole numbers, DECIMAL(22,3) of weights."""
    return F.sum(_col(c))


def when_else(cond: Column, c, otherwise=0) -> Column:
    """``CASE WHEN cond THEN c ELSE otherwise END``."""
    return F.when(cond, _col(c)).otherwise(F.lit(otherwise))


def conditional_sum(cond: Column, c, otherwise=0) -> Column:
    """``SUM(CASE WHEN cond THEN c ELSE otherwise END)``; never NULL for non-empty groups."""
    return qty_sum(when_else(cond, c, otherwise))


def exact_avg(c) -> Column:
    """Unweighted mean of the non-NULL values: ``double(sum) / count``."""
    return F.try_divide(F.sum(_col(c)).cast("double"), F.count(_col(c)))


def representative(cols, by) -> Column:
    """A struct of ``cols`` taken from the row with the smallest ``by``.

    Stands in for a bare non-grouped column in a loose GROUP BY: all fields
    come from one row, chosen deterministically.  NULL fields are kept.
    """
    names = [cols] if isinstance(cols, str) else list(cols)
    return F.min_by(F.struct(*[F.col(n) for n in names]), _col(by))


def unpack(struct_col: str, names, prefix: str = "") -> list[Column]:
    """Columns ``struct_col.name`` aliased to ``prefix + name``."""
    return [F.col(f"{struct_col}.{n}").alias(prefix + n) for n in names]


def collated(names, collation: str | None) -> tuple[list[Column], list[Column]]:
    """Group keys of text columns that are equal under ``collation``, and what to show for each.

    The keys are named ``_key_<name>``.  A group of several spellings shows the
    least of them by bytes.  Without a collation the columns are their own keys.
    """
    if collation is None:
        return [F.col(n) for n in names], []
    keys = [F.collate(F.col(n), collation).alias(f"_key_{n}") for n in names]
    return keys, [F.min(n).alias(n) for n in names]

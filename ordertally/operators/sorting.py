"""Result ordering with explicit tie-breakers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sorted_desc(df: DataFrame, by, ties=(), hidden: bool = False, spread_ties: bool = False, settle=None) -> DataFrame:
    """Order by ``by`` descending (NULLs last), then ``ties`` ascending.

    ``hidden=True`` drops the ``by`` column afterwards, for an order by an
    aggregate that is not part of the output.  This is a global sort (a
    range-partitioned shuffle), whose bounds are sampled from its input.

    ``spread_ties=True`` is for rows without a unique key: every row gets a
    number as the last sort key, so no key repeats and no range partition can
    hold a large share of the rows.  The rows are exchanged on all their
    columns and sorted within their partitions before they are numbered, so a
    rerun task numbers, and places, equal rows as before.

    ``settle`` names a column to exchange the rows on first, where nothing
    before the sort does: the sampling then reads the exchanged rows instead
    of scanning the tables a second time.
    """
    keys = [F.desc_nulls_last(by)] + [F.asc_nulls_last(t) for t in ties]
    if spread_ties:
        columns = df.columns
        rest = [F.asc_nulls_last(c) for c in columns if c != by and c not in ties]
        # AQE splits a partition that equal rows fill.
        placed = df.hint("rebalance", *columns).sortWithinPartitions(*columns)
        numbered = placed.withColumn("_copy", F.monotonically_increasing_id())
        out = numbered.orderBy(*keys, *rest, F.asc("_copy")).drop("_copy")
    else:
        if settle is not None:
            df = df.hint("rebalance", settle)
        out = df.orderBy(*keys)
    return out.drop(by) if hidden else out

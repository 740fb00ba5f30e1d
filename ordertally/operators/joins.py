"""Joins of the report tables.

Fact to fact (orders to order lines): when the filtered orders are small
enough, their ids and a few narrow columns are broadcast into the line
scan, so the line table is never shuffled; otherwise it is a shuffled join on
the order id, where AQE splits a skewed id and the runtime bloom filter built
from the filtered orders trims the line scan.

Whether a side is small is read off its plan's statistics if they are well
within the bound (``STATISTICS_BYTES``); beyond them one aggregate measures it.
Sizes are measured anew for every report that is built, so they follow the
tables; within ``measured_once()`` (a bundle run) each side is measured once.

Dimensions (a key and a few columns) are broadcast within the same bound, so
that the rows they are attached to stay where they are; beyond it Catalyst
and AQE choose the join.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Dimensions, and filtered orders, are broadcast up to this many bytes.
BROADCAST_BYTES = 64 << 20
ORDERS_BROADCAST_BYTES = 64 << 20

# Statistics of a plan (for files, their bytes) settle the matter up to here, and up to a sixteenth of the bound:
# files that unpack to sixteen times their size still stay within it.
STATISTICS_BYTES = 4 << 20
UNPACKED = 16

# Statistics of a source that gives none (Spark's default for them is its largest long).
UNKNOWN_BYTES = 1 << 60

# Bytes of a value in a row (text adds its length), and of the row itself.
WORD, ROW_OVERHEAD = 8, 16


def _texts(df: DataFrame) -> list:
    return [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def side_bytes(df: DataFrame) -> int:
    """Bytes that the rows of ``df`` take.

    One aggregate: every task adds up its rows and returns one number.  Without
    texts it is a plain count, which a database catalog's tables compute there.
    """
    fixed = ROW_OVERHEAD + WORD * len(df.columns)
    texts = _texts(df)
    total = F.count(F.lit(1)) * fixed
    if texts:
        total = total + F.coalesce(F.sum(sum(texts, F.lit(0).cast("bigint"))), F.lit(0))
    return df.agg(total.alias("n")).first()["n"]


# Sides measured in the current run: plan hash -> (side, bytes).
_MEASURED: ContextVar[dict[int, list[tuple[DataFrame, int]]] | None] = ContextVar("measured", default=None)


@contextmanager
def measured_once() -> Iterator[None]:
    """Within this block a side is measured once, however many joins it takes part in.

    For one run over one state of the tables; what was measured is forgotten at its end.
    """
    token = _MEASURED.set({})
    try:
        yield
    finally:
        _MEASURED.reset(token)


def _measured_bytes(df: DataFrame) -> int:
    known = _MEASURED.get()
    if known is None:
        return side_bytes(df)
    same_hash = known.setdefault(df.semanticHash(), [])
    for other, size in same_hash:
        if df.sameSemantics(other):
            return size
    size = side_bytes(df)
    same_hash.append((df, size))
    return size


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether the rows of ``df``, measured, are within the bound."""
    return _measured_bytes(df) <= (BROADCAST_BYTES if max_bytes is None else max_bytes)


def plan_bytes(df: DataFrame) -> int:
    """Bytes of ``df`` by Catalyst's statistics: no job; a very large number where nothing is known."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def is_small(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether ``df`` is within the bound, by its statistics or else measured."""
    bound = BROADCAST_BYTES if max_bytes is None else max_bytes
    known = plan_bytes(df)
    if known <= min(bound // UNPACKED, STATISTICS_BYTES):
        return True
    if known >= UNKNOWN_BYTES and _texts(df):
        # A database counts its rows itself; texts are only fetched to be measured if the count alone is within the bound.
        plain = df.select([f.name for f in df.schema.fields if not isinstance(f.dataType, T.StringType)])
        if not fits_broadcast(plain, bound):
            return False
    return fits_broadcast(df, bound)


def small_side(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it is within the bound, else as it is."""
    return F.broadcast(df) if is_small(df) else df


# Rows that inner joins to dimensions drop, for the joins built in the current block.
_DROPS: ContextVar[list[tuple[str, DataFrame]] | None] = ContextVar("drops", default=None)


@contextmanager
def counting_drops() -> Iterator[list[tuple[str, DataFrame]]]:
    """Collects, for the reports built in this block, the rows that their inner joins to dimensions drop.

    Yields a list of (dimension, dropped rows) that fills as joins are built,
    for ``dropped_rows``.  The rows are those that reach the join (a report
    that aggregates first has groups there).  The reports' own plans stay as
    they are: counts observed inside them would take in the rows that the
    final sort's sampling reads as well.
    """
    drops: list[tuple[str, DataFrame]] = []
    token = _DROPS.set(drops)
    try:
        yield drops
    finally:
        _DROPS.reset(token)


def dropped_rows(drops: list[tuple[str, DataFrame]]) -> dict[str, int]:
    """Number of rows dropped by each dimension, counted in one job."""
    out = {name: 0 for name, _ in drops}
    if drops:
        marks = [rows.select(F.lit(name).alias("name")) for name, rows in drops]
        every = reduce(DataFrame.unionByName, marks).groupBy("name").agg(F.count(F.lit(1)).alias("n"))
        out.update({r["name"]: r["n"] for r in every.collect()})  # a row per dimension
    return out


def attach(df: DataFrame, side: DataFrame, on, how: str, name: str) -> DataFrame:
    """Join a dimension, broadcast if it is small.

    ``on`` makes the join condition from the two DataFrames.  Within
    ``counting_drops()`` an inner join leaves the rows that it drops there.
    """
    side = small_side(side)
    drops = _DROPS.get()
    if drops is not None and how == "inner":
        drops.append((name, df.join(side, on(df, side), "left_anti")))
    return df.join(side, on(df, side), how)


def _orders_side(projected: DataFrame, broadcast: bool | None) -> DataFrame:
    if broadcast is None:
        broadcast = is_small(projected, ORDERS_BROADCAST_BYTES)
    return F.broadcast(projected) if broadcast else projected


def order_lines(orders: DataFrame, lines: DataFrame, how: str = "inner", broadcast: bool | None = None) -> DataFrame:
    """Orders joined to their lines on ``orders.id = order_product.order_id``.

    Keeps the line columns plus all order columns; orders without lines drop
    out of an inner join.  ``broadcast=False`` leaves the choice to Catalyst
    and AQE; by default the (already filtered) orders are measured, and
    broadcast if they are within ``ORDERS_BROADCAST_BYTES``.
    """
    o = orders.withColumnRenamed("id", "o_id")
    return lines.join(_orders_side(o, broadcast), lines["order_id"] == F.col("o_id"), how).drop("o_id")


def lines_of(orders: DataFrame, lines: DataFrame, broadcast: bool | None = None) -> DataFrame:
    """Lines whose order is in ``orders`` (a semi join on the order id).

    Equivalent to the inner join when ``orders.id`` is unique, but carries
    no order columns.  Broadcast/shuffle choice as ``order_lines``.
    """
    ids = orders.select(F.col("id").alias("_oid"))
    return lines.join(_orders_side(ids, broadcast), lines["order_id"] == F.col("_oid"), "left_semi")


def with_product(df: DataFrame, products: DataFrame, cols=None, how: str = "inner", prefix: str = "p_") -> DataFrame:
    """Attach product columns on ``product_id = products.id``."""
    cols = cols or [c for c in products.columns if c != "id"]
    p = products.select(F.col("id").alias("_pid"), *[F.col(c).alias(prefix + c) for c in cols])
    return attach(df, p, lambda d, x: d["product_id"] == x["_pid"], how, "products").drop("_pid")


def with_category(df: DataFrame, categories: DataFrame, key: str = "category_id", how: str = "inner") -> DataFrame:
    c = categories.select(F.col("id").alias("_cid"), F.col("name").alias("category_name"))
    return attach(df, c, lambda d, x: d[key] == x["_cid"], how, "categories").drop("_cid")


def with_store(df: DataFrame, store: DataFrame, key: str = "store_id", how: str = "inner") -> DataFrame:
    s = store.select(F.col("id").alias("_sid"), F.col("name").alias("store_name"))
    return attach(df, s, lambda d, x: d[key] == x["_sid"], how, "store").drop("_sid")


ROLES = {"packing": "packing_worker_id", "dispatcher": "dispatcher_worker_id"}


def with_worker(
    df: DataFrame,
    workers: DataFrame,
    role: str = "packing",
    how: str = "left",
    prefix: str = "",
) -> DataFrame:
    """Attach worker names for a role (``packing`` or ``dispatcher``).

    ``how="left"`` keeps rows without a known worker (names NULL); ``inner``
    drops them.  ``workers.id`` must be unique or rows multiply.
    """
    key = ROLES[role]
    w = workers.select(
        F.col("id").alias("_wid"),
        F.col("first_name").alias(prefix + "first_name"),
        F.col("last_name").alias(prefix + "last_name"),
    )
    return attach(df, w, lambda d, x: d[key] == x["_wid"], how, "workers").drop("_wid")


def with_zone(
    df: DataFrame,
    cities: DataFrame,
    city_groups: DataFrame,
    key: str = "city",
    collation: str | None = None,
    how: str = "inner",
) -> DataFrame:
    """Attach the delivery zone: ``city = cities.name``, ``cities.city_group_id = city_groups.id``.

    Unmatched cities drop out (inner).  A city name listed twice multiplies
    its rows, as in SQL.  ``collation`` (e.g. ``"UTF8_LCASE"``) compares
    names with that collation instead of byte equality.
    """
    g = city_groups.select(F.col("id").alias("_gid"), F.col("description").alias("zone"))
    zones = cities.join(small_side(g), cities["city_group_id"] == g["_gid"], "inner").select(
        F.col("name").alias("_city"), F.col("city_group_id"), F.col("zone")
    )

    def same_city(d: DataFrame, x: DataFrame):
        if collation is None:
            return d[key] == x["_city"]
        return F.collate(d[key], collation) == F.collate(x["_city"], collation)

    return attach(df, zones, same_city, how, "cities").drop("_city")

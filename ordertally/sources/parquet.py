"""Parquet table catalog: the eight report tables read with explicit schemas."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertally import schema as S
from ordertally.params import as_date


def table_path(root: str, name: str) -> str:
    """``<root>/<name>`` if it exists, else ``<root>/<name>.parquet``."""
    plain = os.path.join(root, name)
    if os.path.exists(plain) or "://" in root:
        return plain
    return os.path.join(root, f"{name}.parquet")


def load_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One table with its declared schema; pruning and pushdown apply.

    Tables with columns that keep their source's type (``schema.resolved``)
    are typed by their files.
    """
    path = table_path(root, name)
    if name in KEEP_TYPES:
        try:
            found = spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            return spark.read.schema(S.SCHEMAS[name]).parquet(path)  # staged without a row
        return S.conform(found, S.SCHEMAS[name]) if _differs(found, name) else _typed(spark, path, name, found.schema)
    return spark.read.schema(S.SCHEMAS[name]).parquet(path)


# Tables with columns that keep their source's type.
KEEP_TYPES = ("orders", "order_product")


def _typed(spark: SparkSession, path: str, name: str, found) -> DataFrame:
    schema = S.resolved(S.SCHEMAS[name], found)
    extra = [f for f in found.fields if f.name not in schema.names]  # a date partition of the lines
    if extra:
        schema = type(schema)(schema.fields + extra)
    return spark.read.schema(schema).parquet(path)


def _differs(found: DataFrame, name: str) -> bool:
    """Whether the files hold other types than the table, so that values need a checked cast."""
    have = {f.name: f.dataType for f in found.schema.fields}
    return any(have.get(f.name, f.dataType) != f.dataType for f in S.resolved(S.SCHEMAS[name], found.schema).fields)


def load_tables(spark: SparkSession, root: str, names=None) -> dict[str, DataFrame]:
    """All (or the named) report tables under ``root`` as lazy DataFrames."""
    return {n: load_table(spark, root, n) for n in (names or S.SCHEMAS)}


def write_tables(
    tables: dict[str, DataFrame], root: str, mode: str = "overwrite", lines_by_date: bool = True, names=None
) -> None:
    """Store report tables for repeated runs.

    ``orders`` is partitioned by ``delivery_date`` so the period filter of
    every report prunes whole directories.  Rows are rebalanced by date
    before the write (few files per day; AQE splits a very large day) and
    sorted by order id inside each file, so row-group statistics on the id
    let a selective scan or a runtime bloom filter skip row groups.  With ``lines_by_date`` the
    ``order_product`` rows are stored under their order's delivery date too
    (one shuffle join at staging time; lines without an order keep a NULL
    date and are kept).  Reports then read only the period's lines instead
    of the whole line table.  Otherwise lines are written sorted by
    ``order_id`` so row-group statistics let a selective scan skip groups.
    ``names`` limits the tables written (default: every report table present).
    """
    wanted = names or [n for n in S.SCHEMAS if _has(tables, n)]
    # Lines first: whoever sees an order then finds its lines.
    wanted = sorted(wanted, key=lambda n: n != "order_product")
    for name in wanted:
        df = tables[name]
        path = os.path.join(root, name)
        if name == "orders":
            staged = df.hint("rebalance", "delivery_date").sortWithinPartitions("delivery_date", "id")
            staged.write.mode(mode).partitionBy("delivery_date").parquet(path)
        elif name == "order_product" and lines_by_date and _has(tables, "orders"):
            days = tables["orders"].select(F.col("id").alias("_oid"), "delivery_date")
            df = df.drop("delivery_date")  # of an earlier staging
            dated = df.join(days, df["order_id"] == days["_oid"], "left").drop("_oid")
            staged = dated.hint("rebalance", "delivery_date").sortWithinPartitions("delivery_date", "order_id")
            staged.write.mode(mode).partitionBy("delivery_date").parquet(path)
        elif name == "order_product":
            df = df.drop("delivery_date")
            df.sortWithinPartitions("order_id").write.mode(mode).parquet(path)
        else:
            df.write.mode(mode).parquet(path)


# Files of each bucketed table; both sides of a join need the same number.
BUCKETS = 200
BUCKET_COLUMNS = {"orders": "id", "order_product": "order_id"}


def write_bucketed(tables: dict[str, DataFrame], schema: str, root: str, buckets: int = BUCKETS, names=None) -> None:
    """Store report tables as tables of ``schema``, orders and order lines bucketed and sorted by the order id.

    For reports over long periods, whose orders are too many to be broadcast:
    the two large tables then join, and the lines add up per order, where they
    lie, without an exchange.  The files are under ``root``; in a new session
    ``register_bucketed`` names them again.  For short periods the layout of
    ``write_tables`` reads less (one session may use both).  An order's lines
    are one bucket, so an order that holds a large share of all lines is
    better read from the other layout, where AQE splits it.
    """
    from ordertally.sources.catalog import create_schema

    wanted = names or [n for n in S.SCHEMAS if _has(tables, n)]
    create_schema(tables[wanted[0]].sparkSession, schema)
    for name in wanted:
        key = BUCKET_COLUMNS.get(name)
        df = tables[name].repartition(buckets, key) if key else tables[name]
        writer = df.write.mode("overwrite").format("parquet").option("path", os.path.join(root, name))
        if key:
            writer = writer.bucketBy(buckets, key).sortBy(key)
        writer.saveAsTable(f"`{schema}`.`{name}`")


def register_bucketed(spark: SparkSession, schema: str, root: str, buckets: int = BUCKETS, names=None) -> dict[str, DataFrame]:
    """Name the tables that ``write_bucketed`` left under ``root`` in a new session; returns them."""
    from ordertally.sources.catalog import create_schema

    create_schema(spark, schema)
    out = {}
    for name in names or S.SCHEMAS:
        path = os.path.join(root, name)
        columns = spark.read.parquet(path).schema.toDDL()
        key = BUCKET_COLUMNS.get(name)
        clustered = f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS " if key else ""
        spark.sql(f"DROP TABLE IF EXISTS `{schema}`.`{name}`")
        place = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE `{schema}`.`{name}` ({columns}) USING parquet {clustered}LOCATION '{place}'")
        out[name] = spark.table(f"`{schema}`.`{name}`")
    return out


def _has(tables, name: str) -> bool:
    """Membership that also works for lazily built table dicts."""
    try:
        tables[name]
        return True
    except KeyError:
        return False


def lines_between(lines: DataFrame, lo, hi) -> DataFrame:
    """Order lines, restricted to a delivery-date range when they carry one.

    A no-op for the plain line table; on the date-partitioned layout of
    ``write_tables`` it becomes a partition filter on the line scan.  The
    reports still join lines to the filtered orders, so results are the
    same either way.
    """
    if "delivery_date" in lines.columns:
        return lines.filter(F.col("delivery_date").between(F.lit(as_date(lo)), F.lit(as_date(hi))))
    return lines

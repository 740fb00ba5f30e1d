"""Customer reports over long periods, from staged daily partials.

The customer reports (orders per customer in a month or a year) read the same
days again and again.  Here a day's orders are reduced once to a row per
customer: count, sum, least id, and the names on that order.  Such rows merge:
counts and sums add up, first and last day are their days' least and largest,
and the name of the least id over all days is that of the least of the days'
least ids.  A report over a year then reads a row per customer and day instead
of every order, and plain orders only for days that are not closed yet.

Layout under a folder: ``rows`` (partials, partitioned by ``delivery_date``) and
``closed`` (a row per closed day, so days without orders count as closed).
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertally.functions import aggregates as A
from ordertally.functions import predicates as P
from ordertally.functions.dates import date_spine
from ordertally.operators.sorting import sorted_desc
from ordertally.params import ReportParams, as_date, day_list
from ordertally.plans.reports import CUSTOMER_COLS
from ordertally.session import path_exists

Tables = dict[str, DataFrame]


def daily_partials(orders: DataFrame) -> DataFrame:
    """A row per delivery day and customer of the orders that the customer reports cover."""
    o = orders.filter(P.exclude_stores(*P.EXCLUDED_STORES) & P.status_not_in(*P.CANCELLED_STATUSES))
    g = o.groupBy("delivery_date", "customer_id").agg(
        F.count("id").alias("n"),
        F.sum("sum").alias("total"),
        F.count("sum").alias("n_total"),
        F.min("id").alias("least_id"),
        A.representative(CUSTOMER_COLS, "id").alias("_rep"),
    )
    return g.select("customer_id", "n", "total", "n_total", "least_id", *A.unpack("_rep", CUSTOMER_COLS), "delivery_date")


def close_days(spark: SparkSession, t: Tables, root: str, start, end) -> None:
    """Reduce the days from ``start`` to ``end`` and mark them closed; days closed before are replaced.

    The mark comes last: a run that dies before it leaves the days open.
    """
    start, end = as_date(start), as_date(end)
    o = t["orders"].filter(F.col("delivery_date").between(F.lit(start), F.lit(end)))
    rows = daily_partials(o).hint("rebalance", "delivery_date").sortWithinPartitions("delivery_date", "customer_id")
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("delivery_date").parquet(os.path.join(root, "rows"))
    date_spine(spark, start, end).write.mode("append").parquet(os.path.join(root, "closed"))


def _merged(rows: DataFrame) -> DataFrame:
    g = rows.groupBy("customer_id").agg(
        F.min("delivery_date").alias("first_order"),
        F.max("delivery_date").alias("last_order"),
        F.try_divide(F.sum("total").cast("double"), F.sum("n_total")).alias("avg_sum"),
        F.sum("n").alias("order_count"),
        A.representative(CUSTOMER_COLS, "least_id").alias("_rep"),
    )
    return g.select("customer_id", "first_order", "last_order", "avg_sum", "order_count", *A.unpack("_rep", CUSTOMER_COLS))


def _ranges(days: list[dt.date]) -> list[tuple[dt.date, dt.date]]:
    out: list[tuple[dt.date, dt.date]] = []
    for day in sorted(days):
        if out and day == out[-1][1] + dt.timedelta(days=1):
            out[-1] = (out[-1][0], day)
        else:
            out.append((day, day))
    return out


def closed_days(spark: SparkSession, root: str, p: ReportParams) -> set[dt.date]:
    """Closed days of the period (a day each comes to the driver)."""
    path = os.path.join(root, "closed")
    if not path_exists(spark, path):
        return set()
    days = spark.read.parquet(path)
    name = days.columns[0]
    return {r[0] for r in days.filter(F.col(name).between(F.lit(p.start), F.lit(p.end))).distinct().collect()}


def _customer_rows(spark: SparkSession, t: Tables, root: str, p: ReportParams) -> DataFrame:
    every = day_list(p.start, p.end)
    closed = closed_days(spark, root, p)
    rows = None
    kept = os.path.join(root, "rows")
    if closed and path_exists(spark, kept):
        staged = spark.read.parquet(kept)
        rows = staged.filter(_within([d for d in every if d in closed]))
    still_open = [d for d in every if d not in closed]
    if still_open or rows is None:
        fresh = daily_partials(t["orders"].filter(_within(still_open or every)))
        rows = fresh if rows is None else rows.unionByName(fresh)
    return rows


def _within(days: list[dt.date]):
    cond = F.lit(False)
    for lo, hi in _ranges(days):
        cond = cond | F.col("delivery_date").between(F.lit(lo), F.lit(hi))
    return cond


def customer_orders_from_days(spark: SparkSession, t: Tables, root: str, p: ReportParams) -> DataFrame:
    """``reports.customer_orders`` from the closed days under ``root``; only other days' orders are read."""
    return sorted_desc(_merged(_customer_rows(spark, t, root, p)), "order_count", ties=["customer_id"])


def recent_customers_from_days(spark: SparkSession, t: Tables, root: str, p: ReportParams) -> DataFrame:
    """``reports.recent_customers`` in the same way."""
    g = _merged(_customer_rows(spark, t, root, p)).filter(F.col("last_order") >= F.lit(p.cutoff))
    return sorted_desc(g, "order_count", ties=["customer_id"])

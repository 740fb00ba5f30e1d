"""Building-block queries: each source, parameter, filter, join and
aggregate helper applied on its own over the whole tables.

They exercise the helpers that the reports compose, one at a time, so each
can be checked against an independent SQL oracle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertally.functions import aggregates as A
from ordertally.functions import dates as D
from ordertally.functions import predicates as P
from ordertally.operators import joins as J
from ordertally.params import ReportParams
from ordertally.plans.partials import close_days, customer_orders_from_days
from ordertally.session import scratch_path
from ordertally.sources.catalog import run_sql
from ordertally.sources.fixtures import FixtureTables, register_fixtures

Tables = dict[str, DataFrame]


def scan_orders(t: Tables) -> DataFrame:
    """The orders table as read, every column, explicit schema."""
    return t["orders"]


def param_period(spark: SparkSession, t: Tables, p: ReportParams) -> DataFrame:
    """Period filter written in SQL with bound, typed date parameters."""
    return spark.sql(
        "SELECT id AS order_id, delivery_date, status FROM {orders} "
        "WHERE delivery_date BETWEEN :start AND :end AND status NOT IN (4, 11)",
        args={"start": p.start, "end": p.end},
        orders=t["orders"],
    )


# A user's own query with typed date parameters; ``{orders}`` and ``{store}`` are the tables.
STORE_WINDOWS = """
SELECT s.name AS store_name, o.delivery_window, COUNT(*) AS order_count,
  COUNT(DISTINCT o.customer_id) AS customers, CAST(SUM(o.sum) AS DECIMAL(18,2)) AS sum_total,
  MIN(o.delivery_date) AS first_day, MAX(o.delivery_date) AS last_day
FROM {orders} o JOIN {store} s ON s.id = o.store_id
WHERE o.delivery_date BETWEEN :start AND :end AND o.status NOT IN (4, 11)
GROUP BY s.name, o.delivery_window
HAVING MAX(o.delivery_date) >= :cutoff"""


def sql_text_report(spark: SparkSession, t: Tables, p: ReportParams) -> DataFrame:
    """A query given as SQL text: over the named views of a schema if the tables come from files, else over the tables as given."""
    if isinstance(t, FixtureTables):
        text = STORE_WINDOWS.format(orders="orders", store="store")  # plain names, found in the schema
        return run_sql(spark, text, p, schema=register_fixtures(spark, t.sf_dir))
    return run_sql(spark, STORE_WINDOWS, p, tables=t)


def customer_year_from_days(spark: SparkSession, t: Tables, closed: ReportParams, p: ReportParams) -> DataFrame:
    """Customer orders of ``p`` from staged daily partials: the days of ``closed`` are closed first, the rest is read from the orders."""
    root = scratch_path(spark, f"customer-days-{uuid.uuid4().hex}")
    close_days(spark, t, root, closed.start, closed.end)
    return customer_orders_from_days(spark, t, root, p)


def period_last_7(t: Tables, n: int = 7) -> DataFrame:
    """Orders per day in the last-``n``-days period ending on the latest
    delivery day (the data's "today"); inclusive, so ``n + 1`` days."""
    o = t["orders"]
    today = o.select(F.max("delivery_date")).scalar()
    start, end = D.last_n_days_cols(today, n)
    return (
        o.filter(F.col("delivery_date").between(start, end))
        .groupBy("delivery_date")
        .agg(F.count("id").alias("order_count"))
    )


def _day_text(c: str = "delivery_date", window: str = "delivery_window"):
    """The order day written in the input format picked by its window."""
    return (
        F.when(F.col(window) == 0, F.date_format(c, "ddMMyy"))
        .when(F.col(window) == 1, F.date_format(c, "dd.MM.yy"))
        .otherwise(F.date_format(c, "d/M/yy"))
    )


def parse_day(t: Tables) -> DataFrame:
    """Every order's delivery day written in one of the accepted input
    formats, parsed back."""
    o = t["orders"].select(F.col("id").alias("order_id"), _day_text().alias("day_text"))
    return o.select("order_id", "day_text", D.parse_day("day_text").alias("parsed_day"))


def parse_range(t: Tables) -> DataFrame:
    """Range strings built from each order (single day, two days, and two
    days with a trailing extra part), split and parsed."""
    d = F.col("delivery_date")
    w = F.col("delivery_window")
    text = (
        F.when(w == 0, F.date_format(d, "ddMMyy"))
        .when(w == 1, F.concat(F.date_format(d, "ddMMyy"), F.lit("-"), F.date_format(F.date_add(d, 2), "dd.MM.yy")))
        .otherwise(
            F.concat(F.date_format(d, "d/M/yy"), F.lit(" - "), F.date_format(F.date_add(d, 30), "ddMMyy"), F.lit("-x"))
        )
    )
    o = t["orders"].select(F.col("id").alias("order_id"), text.alias("range_text"))
    start, end = D.parse_range("range_text")
    return o.select("order_id", "range_text", start.alias("range_start"), end.alias("range_end"))


def date_spine(t: Tables) -> DataFrame:
    """Every calendar day between the first and last delivery day, with its
    order count (0 on days without orders)."""
    o = t["orders"]
    bounds = o.agg(F.min("delivery_date").alias("lo"), F.max("delivery_date").alias("hi"))
    spine = D.spine_between(bounds, "lo", "hi", "report_date")
    per_day = o.groupBy(F.col("delivery_date").alias("report_date")).agg(F.count("id").alias("n"))
    return spine.join(per_day, "report_date", "left").select(
        "report_date", F.coalesce(F.col("n"), F.lit(0)).alias("order_count")
    )


def filter_period(t: Tables, p: ReportParams) -> DataFrame:
    return t["orders"].filter(P.in_period(p)).select(F.col("id").alias("order_id"), "delivery_date")


def filter_status(t: Tables) -> DataFrame:
    o = t["orders"].filter(P.status_not_in(*P.NEW_CUSTOMER_EXCLUDED_STATUSES))
    return o.select(F.col("id").alias("order_id"), "status")


def filter_store(t: Tables) -> DataFrame:
    o = t["orders"].filter(P.exclude_stores(*P.MISSING_LINES_EXCLUDED_STORES))
    return o.select(F.col("id").alias("order_id"), "store_id")


def order_lines(t: Tables) -> DataFrame:
    o = t["orders"].select("id", "delivery_date")
    lines = t["order_product"].select("order_id", "product_id", "quantity_needed", "quantity")
    return J.order_lines(o, lines).select("order_id", "product_id", "delivery_date", "quantity_needed", "quantity")


def join_product(t: Tables) -> DataFrame:
    lines = t["order_product"].select("order_id", "product_id", "quantity")
    out = J.with_product(lines, t["products"], cols=["name", "packing_action"])
    return out.select(
        "order_id", "product_id", F.col("p_name").alias("product_name"),
        F.col("p_packing_action").alias("packing_action"), "quantity",
    )


def join_store(t: Tables) -> DataFrame:
    o = t["orders"].select(F.col("id").alias("order_id"), "store_id")
    return J.with_store(o, t["store"])


def join_category(t: Tables) -> DataFrame:
    p = t["products"].select(F.col("id").alias("product_id"), "category_id")
    return J.with_category(p, t["categories"])


def join_zone(t: Tables) -> DataFrame:
    o = t["orders"].select(F.col("id").alias("order_id"), "city")
    return J.with_zone(o, t["cities"], t["city_groups"])


def join_packer_left(t: Tables) -> DataFrame:
    o = t["orders"].select(F.col("id").alias("order_id"), "packing_worker_id")
    return J.with_worker(o, t["workers"], role="packing", how="left")


def join_packer_inner(t: Tables) -> DataFrame:
    o = t["orders"].select(F.col("id").alias("order_id"), "packing_worker_id")
    return J.with_worker(o, t["workers"], role="packing", how="inner")


def join_dispatcher_left(t: Tables) -> DataFrame:
    o = t["orders"].select(F.col("id").alias("order_id"), "dispatcher_worker_id")
    return J.with_worker(o, t["workers"], role="dispatcher", how="left", prefix="dispatcher_")


def representative_row(t: Tables) -> DataFrame:
    """Per customer, the name and phone written on the lowest-id order."""
    cols = ["first_name", "last_name", "phone"]
    g = t["orders"].groupBy("customer_id").agg(
        F.min("id").alias("rep_order_id"), A.representative(cols, "id").alias("_rep")
    )
    return g.select("customer_id", "rep_order_id", *A.unpack("_rep", cols))

"""The report queries as DataFrame plans.

Every builder takes the table dict ``t`` (see ``sources``) and parameters,
and returns a DataFrame.  Plans follow the same shape:

* filter ``orders`` on the period first (pushed to the scan, and a runtime
  bloom filter for the order-lines scan);
* join orders to order lines on the order id (the one large shuffle);
* aggregate on the fact keys before attaching dimension names, relying on
  unique ``id`` columns of orders, products, categories, store and workers;
* attach dimensions through size-checked broadcast joins.

Building a report measures the sides it may broadcast (one aggregate each, over
the date-filtered orders and the dimensions); all else is lazy.

Column names are snake_case; ``LABELS`` maps them back to display names.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertally.functions import aggregates as A
from ordertally.functions.dates import date_spine
from ordertally.functions import predicates as P
from ordertally.operators import joins as J
from ordertally.operators.sorting import sorted_desc
from ordertally.params import ReportParams, as_date
from ordertally.sinks.writers import with_empty_dates
from ordertally.sources.parquet import lines_between

Tables = dict[str, DataFrame]


def period_orders(t: Tables, p: ReportParams) -> DataFrame:
    """Orders delivered in the period that are not cancelled (status 4 or 11)."""
    return t["orders"].filter(P.in_period(p) & P.status_not_in(*P.CANCELLED_STATUSES))


def lines_for_days(t: Tables, lo, hi) -> DataFrame:
    """Order lines that can belong to orders delivered in ``[lo, hi]``.

    On the staged layout the date partitions restrict the line scan; the
    reports still join the lines to the filtered orders.
    """
    return lines_between(t["order_product"], lo, hi)


def period_lines(t: Tables, p: ReportParams) -> DataFrame:
    """Order lines that can belong to the period's orders (see ``lines_for_days``)."""
    return lines_for_days(t, p.start, p.end)


# --------------------------------------------------------------------------
# R1: new customers


def new_customers(t: Tables, p: ReportParams, collation: str | None = None) -> DataFrame:
    """Customers whose first order inside the period is on or after the cutoff.

    Grouped by customer, store and the name/phone written on the order, so
    one customer with two phone numbers gives two rows.  Ordered by the
    number of orders, descending.

    With a ``collation`` (e.g. ``"UTF8_LCASE"``) names and phones that are
    equal under it are one group, shown in their least spelling.
    """
    o = t["orders"].filter(
        P.in_period(p)
        & P.exclude_stores(*P.EXCLUDED_STORES)
        & P.status_not_in(*P.NEW_CUSTOMER_EXCLUDED_STATUSES)
    )
    texts = ["first_name", "last_name", "phone"]
    text_keys, shown = A.collated(texts, collation)
    keys = ["customer_id", "store_id", *texts]
    g = (
        o.groupBy("customer_id", "store_id", *text_keys)
        .agg(
            *shown,
            F.min("delivery_date").alias("first_order"),
            F.max("delivery_date").alias("last_order"),
            F.count("delivery_date").alias("number_of_orders"),
            A.exact_avg("sum").alias("avg_sum"),
            F.count("id").alias("_n"),
        )
        .filter(F.col("first_order") >= F.lit(p.cutoff))
    )
    g = J.with_store(g, t["store"])
    out = g.select(
        "customer_id", "store_id", "store_name", "first_order", "last_order",
        "number_of_orders", "avg_sum", "first_name", "last_name", "phone", "_n",
    )
    return sorted_desc(out, "_n", ties=keys, hidden=True)


# --------------------------------------------------------------------------
# R2: packing per order

ORDER_COLS = [
    "wp_id", "delivery_date", "delivery_window", "status", "clearing_status",
    "dhl_package_number", "is_deleted", "sum", "store_id", "packing_worker_id",
]


def packing_orders(t: Tables, p: ReportParams) -> DataFrame:
    """Per order: ordered and packed quantities, and the packed quantity of
    products with packing action 1, with store and packer names.

    Orders need at least one line with a known product and a known store;
    the packer is optional.  Ordered by delivery date, newest first.
    """
    o = period_orders(t, p).select("id", *ORDER_COLS)
    lines = period_lines(t, p).select("order_id", "product_id", "quantity_needed", "quantity")
    # Lines of the period's orders only, then products, then one row per
    # order (partial aggregation before the shuffle, so an order with very
    # many lines collapses map-side); order details are attached last.
    pl = J.with_product(J.lines_of(o, lines), t["products"], cols=["packing_action"])
    per_order = pl.groupBy("order_id").agg(
        A.qty_sum("quantity_needed").alias("total_quantity_needed"),
        A.qty_sum("quantity").alias("total_quantity"),
        A.conditional_sum(F.col("p_packing_action") == 1, "quantity").alias("type_1_quantity"),
    )
    # Order details (wide rows) are joined to the per-order sums without a
    # forced broadcast: both sides are period-sized, and AQE broadcasts at
    # run time only if the measured size is small.
    g = J.order_lines(o, per_order, broadcast=False)
    g = J.with_store(g, t["store"])
    g = J.with_worker(g, t["workers"], role="packing", how="left", prefix="packer_")
    out = g.select(
        "order_id", "wp_id", "delivery_date", "delivery_window", "status",
        "clearing_status", "dhl_package_number", "is_deleted",
        F.col("sum").alias("order_sum"), "total_quantity_needed", "total_quantity",
        "type_1_quantity", "store_id", "store_name", "packing_worker_id",
        "packer_first_name", "packer_last_name",
    )
    return sorted_desc(out, "delivery_date", ties=["order_id"])


# --------------------------------------------------------------------------
# R3: packing per worker


def packing_by_worker(t: Tables, p: ReportParams) -> DataFrame:
    """Per packing worker (NULL is its own group): distinct orders, packed
    quantity, and the sum of the distinct order totals (equal totals of two
    orders count once).  Ordered by the number of order lines, descending.

    Distinct aggregates are computed in three grouped steps (order, then
    worker and order total, then worker), each with a map-side partial
    aggregate, so a worker holding most orders never lands in one task.
    """
    o = period_orders(t, p).select("id", "packing_worker_id", "sum")
    lines = period_lines(t, p).select("order_id", "quantity")
    # Worker and order total are fixed-width: they come along with the order id.
    per_order = J.order_lines(o, lines).groupBy("order_id", "packing_worker_id", "sum").agg(
        F.sum("quantity").alias("q"), F.count(F.lit(1)).alias("n_lines")
    )
    per_total = per_order.groupBy("packing_worker_id", "sum").agg(
        F.count("order_id").alias("n_orders"), F.sum("q").alias("q"), F.sum("n_lines").alias("n_lines")
    )
    per_worker = per_total.groupBy("packing_worker_id").agg(
        F.sum("n_orders").cast("bigint").alias("order_count"),
        F.sum("q").alias("quantity"),
        A.money_sum("sum").alias("distinct_sum"),
        F.sum("n_lines").alias("_n"),
    )
    g = J.with_worker(per_worker, t["workers"], role="packing", how="left")
    out = g.select("packing_worker_id", "first_name", "last_name", "order_count", "quantity", "distinct_sum", "_n")
    return sorted_desc(out, "_n", ties=["packing_worker_id"], hidden=True)


# --------------------------------------------------------------------------
# R4: missing lines


def missing_lines(t: Tables, p: ReportParams) -> DataFrame:
    """Order lines packed short (needed > packed), with product, store and
    packer.  Only orders with a known packer appear (inner join).  Stores
    82, 84 and 85 are left out.  Ordered by order id, descending.
    """
    o = period_orders(t, p).filter(P.exclude_stores(*P.MISSING_LINES_EXCLUDED_STORES))
    o = o.select("id", "store_id", "sum", "packing_worker_id")
    lines = period_lines(t, p).filter(F.col("quantity_needed") > F.col("quantity"))
    lines = lines.select("order_id", "product_id", "quantity_needed", "quantity")
    ol = J.order_lines(o, lines)
    ol = J.with_product(ol, t["products"], cols=["name", "name_heb", "name_weight"])
    ol = J.with_store(ol, t["store"])
    ol = J.with_worker(ol, t["workers"], role="packing", how="inner")
    out = ol.select(
        "store_id", "store_name", "order_id",
        F.col("sum").alias("order_sum"),
        F.col("quantity_needed").alias("order_quantity"),
        F.col("quantity").alias("delivered_quantity"),
        A.missing_quantity().alias("missing_quantity"),
        "product_id",
        F.col("p_name").alias("product_name"),
        F.col("p_name_heb").alias("name_heb"),
        F.col("p_name_weight").alias("name_weight"),
        "packing_worker_id", "first_name", "last_name",
    )
    # Lines carry no unique key, and a hot order may repeat a product.
    return sorted_desc(out, "order_id", ties=["product_id"], spread_ties=True)


# --------------------------------------------------------------------------
# R5: product totals

# Room for a price in cents, moved above zero by ``_ZERO``; a NULL price takes
# the last place, so it counts only if the order has no other.
_PLACES, _ZERO = 10**13, 10**12


def _packed_price():
    cents = F.coalesce((F.col("unit_price") * 100).cast("bigint") + F.lit(_ZERO), F.lit(_PLACES - 1))
    return (F.col("order_id").cast("decimal(19,0)") * F.lit(_PLACES).cast("decimal(14,0)") + cents).cast("decimal(38,0)")


def _unpacked_price(packed: str):
    place = F.pmod(F.col(packed), F.lit(_PLACES).cast("decimal(38,0)")).cast("bigint")
    cents = (place - F.lit(_ZERO)).cast("decimal(14,0)")
    return F.when(place < _PLACES - 1, (cents / 100).cast("decimal(12,2)"))



def product_totals(t: Tables, p: ReportParams) -> DataFrame:
    """Per product: quantities ordered, billed, delivered and replaceable,
    each with its value at the line price; the mean line price; and one
    line price as ``order_price`` (the lowest non-NULL price among the
    product's lines of its lowest order id).  Products need a known
    category.  Ordered by the ordered quantity, descending.
    """
    o = period_orders(t, p).filter(P.exclude_stores(*P.EXCLUDED_STORES)).select("id")
    lines = period_lines(t, p).select(
        "order_id", "product_id", "quantity_needed", "quantity",
        "quantity_delivered", "quantity_replaceable", "unit_price",
    )
    ol = J.lines_of(o, lines)
    # One hash aggregate per product, so only partial rows are exchanged.
    # The price of the lowest order id comes from the least packed number
    # (order id, then price), which needs no sort as a struct would.
    aggs = [
        F.min(_packed_price()).alias("_price"),
        F.try_divide(F.sum("unit_price").cast("double"), F.count("unit_price")).alias("avg_unit_price"),
    ]
    for qty, name in (
        ("quantity_needed", "ordered"),
        ("quantity", "billed"),
        ("quantity_delivered", "delivered"),
        ("quantity_replaceable", "replaceable"),
    ):
        aggs.append(A.qty_sum(qty).alias(f"quantity_{name}"))
        aggs.append(A.money_sum(A.line_value(qty, "unit_price")).alias(f"total_{name}"))
    g = ol.groupBy("product_id").agg(*aggs).withColumn("order_price", _unpacked_price("_price"))
    g = J.with_product(g, t["products"], cols=["name_heb", "category_id", "price", "low_cost_price"], prefix="p_")
    g = J.with_category(g, t["categories"], key="p_category_id")
    out = g.select(
        "product_id",
        F.col("p_name_heb").alias("product_name"),
        F.col("p_category_id").alias("category_id"),
        "category_name",
        F.col("p_price").alias("list_price"),
        F.col("p_low_cost_price").alias("low_cost_price"),
        "order_price", "avg_unit_price",
        "quantity_ordered", "total_ordered", "quantity_billed", "total_billed",
        "quantity_delivered", "total_delivered", "quantity_replaceable", "total_replaceable",
    )
    return sorted_desc(out, "quantity_ordered", ties=["product_id"])


# --------------------------------------------------------------------------
# R6-R9: customer orders

CUSTOMER_COLS = ["first_name", "last_name", "phone"]


def customer_orders(t: Tables, p: ReportParams) -> DataFrame:
    """Per customer: first and last order day, mean order total, number of
    orders, and the name and phone of the customer's lowest-id order.
    Stores 84 and 85 are left out.  Ordered by order count, descending.

    Serves the weekly, second-month and yearly reports: they differ only
    in the period passed.
    """
    return sorted_desc(_customer_groups(t, p), "order_count", ties=["customer_id"])


def recent_customers(t: Tables, p: ReportParams) -> DataFrame:
    """``customer_orders`` restricted to customers whose last order in the
    period is on or after the cutoff."""
    g = _customer_groups(t, p).filter(F.col("last_order") >= F.lit(p.cutoff))
    return sorted_desc(g, "order_count", ties=["customer_id"])


# Beyond this many bytes of orders (by the plan's statistics) names are looked up in a second step.
TWO_STEP_BYTES = 256 << 20


def _customer_groups(t: Tables, p: ReportParams, two_steps: bool | None = None) -> DataFrame:
    """Orders per customer, with the names on the lowest order id.

    Names as aggregation buffers need a sort aggregate, which is quicker for
    few orders.  For many, the hash aggregate keeps the lowest id alone and
    the names are joined to it once after it: on 6 million orders that takes
    4.9 s instead of 7.8 (without broadcasts; README).  Both give the same rows.
    """
    o = period_orders(t, p).filter(P.exclude_stores(*P.EXCLUDED_STORES))
    if two_steps is None:
        two_steps = J.plan_bytes(o) > TWO_STEP_BYTES
    g = o.groupBy("customer_id").agg(
        F.min("delivery_date").alias("first_order"),
        F.max("delivery_date").alias("last_order"),
        A.exact_avg("sum").alias("avg_sum"),
        F.count("id").alias("order_count"),
        (F.min("id") if two_steps else A.representative(CUSTOMER_COLS, "id")).alias("_rep"),
    )
    totals = ["customer_id", "first_order", "last_order", "avg_sum", "order_count"]
    if two_steps:
        named = o.select(F.col("id").alias("_id"), *CUSTOMER_COLS)
        return g.join(named, F.col("_rep") == F.col("_id")).select(*totals, *CUSTOMER_COLS)
    return g.select(*totals, *A.unpack("_rep", CUSTOMER_COLS))


# --------------------------------------------------------------------------
# R10: orders with their coupon and discount fields


def coupon_orders(t: Tables, p: ReportParams) -> DataFrame:
    """Orders of the period with totals, discounts and coupons (orders
    without a coupon included).  Ordered by order id, descending."""
    o = period_orders(t, p).filter(P.exclude_stores(*P.EXCLUDED_STORES))
    out = o.select(
        F.col("id").alias("order_id"), "customer_id", "created_date", "sum",
        "discount_sum", "discount_promotions", "coupons",
    )
    return sorted_desc(out, "order_id", settle="order_id")


# --------------------------------------------------------------------------
# R11, R12: delivery zones


def _zone_groups(t: Tables, p: ReportParams, excluded_stores=(), collation: str | None = None) -> DataFrame:
    """Orders counted and summed per (store, city) first, then given zones.

    The zone join multiplies a pre-aggregated row exactly as it would
    multiply each order, so additive totals are unchanged.
    """
    o = period_orders(t, p)
    if excluded_stores:
        o = o.filter(P.exclude_stores(*excluded_stores))
    pre = o.groupBy("store_id", "city").agg(
        F.count("id").alias("n"), F.sum("sum").alias("s"), F.min("id").alias("min_id")
    )
    z = J.with_zone(pre, t["cities"], t["city_groups"], collation=collation).filter(P.non_empty("zone"))
    return J.with_store(z, t["store"])


def zone_store_totals(t: Tables, p: ReportParams, collation: str | None = None) -> DataFrame:
    """Order count and total per store and delivery zone (zones with an
    empty description are left out; all stores included).  Unordered.

    ``collation`` (e.g. ``"UTF8_LCASE"``) matches city names, and groups store
    and zone names, with that collation, for sources whose database compares
    text case-insensitively.
    """
    z = _zone_groups(t, p, collation=collation)
    keys, shown = A.collated(["store_name", "zone"], collation)
    g = z.groupBy("store_id", *keys).agg(
        *shown, F.sum("n").cast("bigint").alias("order_count"), A.money_sum("s").alias("sum_total")
    )
    return g.select("store_id", "store_name", "zone", "order_count", "sum_total")


def zone_totals(t: Tables, p: ReportParams, collation: str | None = None) -> DataFrame:
    """Order count and total per delivery zone, store 84 left out.

    ``store_id`` and ``store_name`` are those of the zone's lowest-id order
    (the source shows an arbitrary one).  Ordered by order count, descending.
    """
    z = _zone_groups(t, p, excluded_stores=P.ZONE_EXCLUDED_STORES, collation=collation)
    keys, shown = A.collated(["zone"], collation)
    g = z.groupBy(*keys).agg(
        *shown,
        F.sum("n").cast("bigint").alias("order_count"),
        A.money_sum("s").alias("sum_total"),
        F.min_by(F.struct("store_id", "store_name"), "min_id").alias("_rep"),
    )
    out = g.select(
        *A.unpack("_rep", ["store_id", "store_name"]), "order_count", "zone", "sum_total"
    )
    return sorted_desc(out, "order_count", ties=["zone"])


# --------------------------------------------------------------------------
# R13: daily line detail


def daily_detail(t: Tables, day) -> DataFrame:
    """Every line of the day's orders in windows 0 and 1 with status 0, 3
    or 7, with product name, description, catalog price and list."""
    o = t["orders"].filter(
        P.on_day(day) & P.window_in(0, 1) & P.status_in(*P.DAILY_STATUSES)
    ).select("id")
    lines = lines_for_days(t, day, day).select("order_id", "product_id", "quantity", "quantity_needed")
    ol = J.lines_of(o, lines)
    ol = J.with_product(ol, t["products"], cols=["name", "name_heb", "price", "product_list"], prefix="")
    return ol.select("product_id", "name", "name_heb", "price", "product_list", "quantity", "quantity_needed")


# --------------------------------------------------------------------------
# R14: daily product demand over a range, one pass


def daily_product_totals(t: Tables, start, end=None, strict_status: bool = False) -> DataFrame:
    """Per report day and product: needed and supplied quantity and their
    value at the catalog price, for every day from ``start`` to ``end``.

    A day ``D`` covers window-1 orders delivered on ``D`` and window-0
    orders delivered on ``D + 1`` (status 0, 3 or 7; with
    ``strict_status`` the status test covers both).  Each order maps to one
    day, so the whole range is one grouped pass keyed by ``report_date``.
    The redundant delivery-date range is what reaches the Parquet scan.
    """
    s = as_date(start)
    e = as_date(end) if end is not None else s
    if e < s:
        raise ValueError(f"range ends before it starts: {s} > {e}")
    o = (
        t["orders"]
        .filter(F.col("delivery_date").between(F.lit(s), F.lit(e + dt.timedelta(days=1))))
        .withColumn("report_date", P.report_day(strict_status))
        .filter(F.col("report_date").between(F.lit(s), F.lit(e)))
        .select("id", "report_date")
    )
    lines = lines_for_days(t, s, e + dt.timedelta(days=1))
    lines = lines.select("order_id", "product_id", "quantity_needed", "quantity")
    ol = J.order_lines(o, lines)
    g = ol.groupBy("report_date", "product_id").agg(
        A.qty_sum("quantity_needed").alias("quantity_needed"),
        A.qty_sum("quantity").alias("total_supplied"),
    )
    g = J.with_product(g, t["products"], cols=["name", "name_heb", "price", "product_list"], prefix="p_")
    return g.select(
        "report_date", "product_id",
        F.col("p_name").alias("name"),
        F.col("p_name_heb").alias("description"),
        "quantity_needed", "total_supplied",
        F.col("p_price").alias("unit_price"),
        (F.col("p_price") * F.col("total_supplied")).cast(A.MONEY_TOTAL).alias("total_cost"),
        F.col("p_product_list").alias("product_list"),
    )


# Display headers of the source reports (column -> header),
# for sinks that want the original sheet headers.  Headers the source leaves
# as raw expressions are not listed; those columns keep their own names.
LABELS: dict[str, dict[str, str]] = {
    "new_customers": {
        "store_name": "name",
        "first_order": "first order",
        "last_order": "last order",
        "number_of_orders": "number of orders",
    },
    "packing_orders": {
        "order_id": "id",
        "order_sum": "order sum",
        "total_quantity_needed": "total_order_quantity_needed",
        "total_quantity": "total_order_quantity",
        "store_name": "name",
    },
    "missing_lines": {
        "store_name": "name",
        "order_id": "order id",
        "order_sum": "order sum",
        "order_quantity": "order quantity",
        "delivered_quantity": "delivered quantity",
        "missing_quantity": "missing quantity",
    },
    "product_totals": {
        "product_id": "product id",
        "product_name": "product name",
        "category_id": "category id",
        "category_name": "category name",
        "low_cost_price": "990 price",
        "order_price": "order price",
        "avg_unit_price": "average product price",
        "quantity_ordered": "order quantity by client",
        "quantity_billed": "order quantity billed",
        "quantity_delivered": "order delivered",
        "quantity_replaceable": "order replaceable",
    },
    "customer_orders": {"first_order": "first order", "last_order": "last order"},
    "recent_customers": {"first_order": "first order", "last_order": "last order"},
    "coupon_orders": {"order_id": "id"},
    "daily_product_totals": {
        "product_id": "מזהה מוצר",
        "name": "שם מוצר",
        "description": "תיאור מוצר",
        "quantity_needed": "הכמות הנדרשת",
        "total_supplied": "Total_Supplied",
        "unit_price": "מחיר ליחידה",
        "total_cost": "עלות כוללת",
        "product_list": "רשימת מוצרים",
    },
}
LABELS["second_month_orders"] = LABELS["yearly_orders"] = LABELS["customer_orders"]


def daily_status(t: Tables, start, end=None, strict_status: bool = False) -> DataFrame:
    """Per day of the range: rows of ``daily_product_totals`` and a
    ``'No Data'`` marker for days without any."""
    e = end if end is not None else start
    spark = t["orders"].sparkSession
    totals = daily_product_totals(t, start, e, strict_status)
    return with_empty_dates(totals, date_spine(spark, start, e))

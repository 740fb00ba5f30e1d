"""The report catalog: named reports in the order of the weekly bundle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ordertally.plans import reports as R

# name -> builder(t, params).  The weekly bundle runs them in this order,
# all with the same period; "second_month_orders" and "yearly_orders" are
# the customer report under their own names so a caller can give them
# their own periods.
WEEKLY_REPORTS: dict[str, Callable[..., DataFrame]] = {
    "new_customers": R.new_customers,
    "packing_orders": R.packing_orders,
    "packing_by_worker": R.packing_by_worker,
    "missing_lines": R.missing_lines,
    "product_totals": R.product_totals,
    "customer_orders": R.customer_orders,
    "second_month_orders": R.customer_orders,
    "yearly_orders": R.customer_orders,
    "recent_customers": R.recent_customers,
    "coupon_orders": R.coupon_orders,
    "zone_store_totals": R.zone_store_totals,
    "zone_totals": R.zone_totals,
}

# Reports whose row count has a fixed bound (workers, stores x zones, zones),
# whatever the data volume; only these are written as one ordered file.
# Customer and product reports grow with the business and keep the
# range-partitioned files of their sort (part files in order).
BOUNDED_RESULTS = {"packing_by_worker", "zone_store_totals", "zone_totals"}

# Every report by name.  The weekly ones take ``(t, params)``; the daily ones
# take ``(t, day)`` and ``(t, start, end, strict_status=False)``.
REPORTS: dict[str, Callable[..., DataFrame]] = {
    **WEEKLY_REPORTS,
    "daily_detail": R.daily_detail,
    "daily_product_totals": R.daily_product_totals,
    "daily_status": R.daily_status,
}

# Reports that group or join by text and take a ``collation``.
COLLATED = {"new_customers", "zone_store_totals", "zone_totals"}

# Tables that each report reads.
READS: dict[str, tuple[str, ...]] = {
    "new_customers": ("orders", "store"),
    "packing_orders": ("orders", "order_product", "products", "store", "workers"),
    "packing_by_worker": ("orders", "order_product", "workers"),
    "missing_lines": ("orders", "order_product", "products", "store", "workers"),
    "product_totals": ("orders", "order_product", "products", "categories"),
    "customer_orders": ("orders",),
    "second_month_orders": ("orders",),
    "yearly_orders": ("orders",),
    "recent_customers": ("orders",),
    "coupon_orders": ("orders",),
    "zone_store_totals": ("orders", "store", "cities", "city_groups"),
    "zone_totals": ("orders", "store", "cities", "city_groups"),
    "daily_detail": ("orders", "order_product", "products"),
    "daily_product_totals": ("orders", "order_product", "products"),
    "daily_status": ("orders", "order_product", "products"),
}

# Tables whose key a report's plan needs to be unique: it joins them after it
# has aggregated, or keeps a row per order.  Elsewhere a repeated key
# multiplies rows here as it does in SQL.
RELIES_ON: dict[str, tuple[str, ...]] = {
    "new_customers": ("store",),
    "packing_orders": ("orders", "store", "workers"),
    "packing_by_worker": ("orders", "workers"),
    "product_totals": ("orders", "products", "categories"),
    "customer_orders": ("orders",),
    "second_month_orders": ("orders",),
    "yearly_orders": ("orders",),
    "recent_customers": ("orders",),
    "daily_detail": ("orders",),
    "daily_product_totals": ("products",),
    "daily_status": ("products",),
}


def run_report(name: str, t: dict[str, DataFrame], p, **options) -> DataFrame:
    """A report by its name, for the period ``p`` (``ReportParams``).

    The daily reports take their days from the period: ``daily_detail`` its
    first one, the others all of them.
    """
    if name not in REPORTS:
        raise ValueError(f"unknown report {name!r}; use one of {', '.join(sorted(REPORTS))}")
    if name == "daily_detail":
        return REPORTS[name](t, p.start, **options)
    if name in WEEKLY_REPORTS:
        return REPORTS[name](t, p, **options)
    return REPORTS[name](t, p.start, p.end, **options)

"""Cross-report properties on the generated data."""

import os
import tempfile

from pyspark.sql import functions as F

import __spark_entry__ as E
from ordertally.functions import aggregates as A
from ordertally.functions import predicates as P
from ordertally.plans import reports as R
from ordertally.sinks import writers as W
from ordertally.sources import fixtures as FX

SF = "/root/testdata/sf0.01"


def _canon(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(sorted(df.columns)).collect())


def test_zone_totals_add_up_to_store_zone_totals_without_store_84(spark):
    t = FX.fixture_tables(spark, SF)
    by_store = R.zone_store_totals(t, E.PERIOD).filter(F.col("store_id") != 84)
    by_zone = R.zone_totals(t, E.PERIOD)
    a = by_store.agg(F.sum("order_count"), F.sum("sum_total")).first()
    b = by_zone.agg(F.sum("order_count"), F.sum("sum_total")).first()
    assert tuple(a) == tuple(b) and a[0] > 0


def test_recent_customers_are_customer_orders_rows(spark):
    t = FX.fixture_tables(spark, SF)
    recent = set(_canon(R.recent_customers(t, E.PERIOD)))
    everyone = set(_canon(R.customer_orders(t, E.PERIOD)))
    assert recent and recent <= everyone


def test_packing_orders_equals_direct_join_then_group(spark):
    """Aggregating lines per order before the order join equals the literal
    join of all five tables grouped by the order."""
    t = FX.fixture_tables(spark, SF)
    o = t["orders"].filter(P.in_period(E.PERIOD) & P.status_not_in(4, 11))
    lines = t["order_product"]
    prod = t["products"].select(F.col("id").alias("pid"), "packing_action")
    store = t["store"].select(F.col("id").alias("sid"), F.col("name").alias("store_name"))
    wp = t["workers"].select(F.col("id").alias("wid"), F.col("first_name").alias("packer_first_name"),
                             F.col("last_name").alias("packer_last_name"))
    wd = t["workers"].select(F.col("id").alias("did"))
    j = (o.join(lines, o["id"] == lines["order_id"])
         .join(store, o["store_id"] == store["sid"])
         .join(prod, lines["product_id"] == prod["pid"])
         .join(wp, o["packing_worker_id"] == wp["wid"], "left")
         .join(wd, o["dispatcher_worker_id"] == wd["did"], "left"))
    keys = ["wp_id", "delivery_date", "delivery_window", "status", "clearing_status", "dhl_package_number",
            "is_deleted", "store_id", "store_name", "packing_worker_id", "packer_first_name", "packer_last_name"]
    direct = j.groupBy(F.col("id").alias("order_id"), F.col("sum").alias("order_sum"), *keys).agg(
        A.qty_sum("quantity_needed").alias("total_quantity_needed"),
        A.qty_sum(lines["quantity"]).alias("total_quantity"),
        A.conditional_sum(F.col("packing_action") == 1, lines["quantity"]).alias("type_1_quantity"),
    )
    assert _canon(direct) == _canon(R.packing_orders(t, E.PERIOD))


def test_daily_range_equals_union_of_days_on_generated_data(spark):
    t = FX.fixture_tables(spark, SF)
    whole = R.daily_product_totals(t, "1998-02-25", "1998-03-01")
    parts = None
    for d in ["1998-02-25", "1998-02-26", "1998-02-27", "1998-02-28", "1998-03-01"]:
        one = R.daily_product_totals(t, d)
        parts = one if parts is None else parts.unionByName(one)
    assert _canon(whole) == _canon(parts)
    assert len(_canon(whole)) > 0


def test_write_bundle_with_display_labels(spark):
    t = FX.fixture_tables(spark, "/root/testdata/sf0.001")
    out = tempfile.mkdtemp(prefix="ordertally-labels-")
    results = {"product_totals": R.product_totals(t, E.PERIOD),
               "daily_product_totals": R.daily_product_totals(t, FX.RANGE_START, FX.RANGE_END)}
    counts = W.write_bundle(results, out, fmt="csv", display_labels=R.LABELS, single_file={"product_totals"})
    assert counts["product_totals"] > 0
    back = spark.read.option("header", "true").csv(os.path.join(out, "daily_product_totals"))
    assert "עלות כוללת" in back.columns and "Total_Supplied" in back.columns
    assert back.count() == counts["daily_product_totals"]

"""A hot key at run time: one order holds a third of all lines.

On the shuffled (long-period) path AQE must split that order's partition
in the order/line join, and results must stay exact.  Thresholds are
scaled down so a 200k-line table counts as skewed.
"""

import contextlib
import datetime as dt
import io

import pytest
from tables import make_tables
from pyspark.sql import functions as F

from ordertally import schema as S
from ordertally.operators import joins as J
from ordertally.params import ReportParams
from ordertally.plans import reports as R

P = ReportParams("2025-01-01", "2025-01-07")
HOT = 5
N_LINES = 200_000


@pytest.fixture()
def skew_session(spark, monkeypatch):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    monkeypatch.setattr(J, "ORDERS_BROADCAST_BYTES", 0)  # long period: shuffled order/line join
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _tables(spark):
    t = make_tables(spark)
    orders = spark.range(1, 1001).select(
        F.col("id"), F.lit(dt.date(2025, 1, 2)).alias("delivery_date"), F.lit(0).alias("status"),
        F.lit(81).alias("store_id"), (F.col("id") % 8 + 1).alias("packing_worker_id"),
        F.lit(10).cast("decimal(12,2)").alias("sum"),
    )
    t["orders"] = S.conform(orders.select(
        *[F.col(f.name) if f.name in orders.columns else F.lit(None).cast(f.dataType).alias(f.name)
          for f in S.ORDERS.fields]
    ), S.ORDERS)
    lines = spark.range(0, N_LINES).select(
        F.when(F.col("id") % 3 == 0, F.lit(HOT)).otherwise(F.col("id") % 1000 + 1).alias("order_id"),
        (F.col("id") % 2 + 1).alias("product_id"),
        F.lit(2).alias("quantity_needed"), F.lit(1).alias("quantity"), F.lit(1).alias("quantity_delivered"),
        F.lit(0).alias("quantity_replaceable"), F.lit(5).cast("decimal(12,2)").alias("unit_price"),
    )
    t["order_product"] = S.conform(lines, S.ORDER_PRODUCT)
    return t


def _final_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_hot_order_is_split_and_totals_stay_exact(skew_session):
    t = _tables(skew_session)
    df = R.packing_orders(t, P)
    rows = {r["order_id"]: r for r in df.collect()}
    plan = _final_plan(df)
    assert "isFinalPlan=true" in plan
    assert "SortMergeJoin(skew=true)" in plan
    expected_hot = sum(1 for i in range(N_LINES) if i % 3 == 0 or i % 1000 + 1 == HOT)
    assert rows[HOT]["total_quantity"] == expected_hot
    assert rows[HOT]["total_quantity_needed"] == 2 * expected_hot
    assert sum(r["total_quantity"] for r in rows.values()) == N_LINES


def test_hot_order_in_product_totals(skew_session):
    t = _tables(skew_session)
    got = {r["product_id"]: r for r in R.product_totals(t, P).collect()}
    assert sum(r["quantity_billed"] for r in got.values()) == N_LINES
    assert got[1]["order_price"] == 5


def test_hot_order_stays_spread_on_the_shared_path(skew_session):
    from ordertally.params import ReportParams
    from ordertally.plans import bundle as Bn

    t = _tables(skew_session)
    p = ReportParams("2025-01-01", "2025-01-03")
    shared = Bn.shared_inputs(t, p, "persist")
    try:
        sizes = sorted(shared.tables["order_product"].rdd.glom().map(len).collect())
        assert sum(sizes) == N_LINES and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    finally:
        shared.release()

"""Incremental daily totals: each arrival of order days refreshes their report days."""

import os
import tempfile

from tables import D, make_tables

from ordertally.plans import reports as R
from ordertally.sources import parquet as PQ
from ordertally.streaming import daily as SD


def _canon(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(sorted(df.columns)).collect())


def test_incremental_daily_totals_match_batch(spark):
    root = tempfile.mkdtemp(prefix="ordertally-stream-src-")
    out = os.path.join(tempfile.mkdtemp(prefix="ordertally-stream-out-"), "daily")
    ckpt = os.path.join(tempfile.mkdtemp(prefix="ordertally-stream-ckpt-"), "c")
    first = make_tables(
        spark,
        orders=[
            {"id": 1, "delivery_date": D("2025-01-02"), "delivery_window": 1},
            {"id": 2, "delivery_date": D("2025-01-03"), "delivery_window": 0, "status": 3},
        ],
        lines=[{"order_id": 1, "quantity": 2}, {"order_id": 2, "quantity": 5}],
    )
    PQ.write_tables(first, root)
    q = SD.start_daily_totals(spark, root, out, checkpoint=ckpt)
    q.awaitTermination()
    assert _canon(spark.read.parquet(out)) == _canon(R.daily_product_totals(first, "2025-01-01", "2025-01-03"))

    # a later day arrives: only its report days are recomputed, earlier ones stay
    later = make_tables(
        spark,
        orders=[{"id": 3, "delivery_date": D("2025-01-05"), "delivery_window": 1}],
        lines=[{"order_id": 3, "quantity": 7}],
    )
    PQ.write_tables({"orders": later["orders"], "order_product": later["order_product"]}, root, mode="append")
    q = SD.start_daily_totals(spark, root, out, checkpoint=ckpt)
    q.awaitTermination()
    everything = PQ.load_tables(spark, root)
    assert _canon(spark.read.parquet(out)) == _canon(R.daily_product_totals(everything, "2025-01-01", "2025-01-05"))


def test_lines_that_land_late_and_days_that_empty(spark):
    root = tempfile.mkdtemp(prefix="ordertally-stream-src-")
    out = os.path.join(tempfile.mkdtemp(prefix="ordertally-stream-out-"), "daily")
    ckpt = os.path.join(tempfile.mkdtemp(prefix="ordertally-stream-ckpt-"), "c")

    def step():
        SD.start_daily_totals(spark, root, out, checkpoint=ckpt).awaitTermination()
        return sorted({str(r.report_date) for r in spark.read.parquet(out).collect()})

    days = ["2025-01-02", "2025-01-05", "2024-01-05"]
    world = make_tables(
        spark,
        orders=[{"id": i, "delivery_date": D(d), "delivery_window": 1} for i, d in enumerate(days)],
        lines=[{"order_id": 0}, {"order_id": 1}, {"order_id": 2}],
    )
    first = {**world, "orders": world["orders"].filter("id = 0"), "order_product": world["order_product"].filter("order_id = 0")}
    PQ.write_tables(first, root)
    assert step() == ["2025-01-02"]
    # an order without its lines yet, then the lines
    PQ.write_tables({"orders": world["orders"].filter("id = 1")}, root, mode="append", names=["orders"])
    assert step() == ["2025-01-02"]
    late = {"orders": world["orders"], "order_product": world["order_product"].filter("order_id = 1")}
    PQ.write_tables(late, root, mode="append", names=["order_product"])
    assert step() == ["2025-01-02", "2025-01-05"]
    # an order a year back recomputes only its own days
    calls, refresh = [], SD.refresh_days
    SD.refresh_days = lambda *a: (calls.append(a[3:5]), refresh(*a))
    try:
        PQ.write_tables(
            {"orders": world["orders"].filter("id = 2"), "order_product": world["order_product"].filter("order_id = 2")},
            root, mode="append", names=["orders", "order_product"],
        )
        assert step() == ["2024-01-05", "2025-01-02", "2025-01-05"]
    finally:
        SD.refresh_days = refresh
    assert calls == [(D("2024-01-04"), D("2024-01-05"))]
    # a day that has no rows any more loses its partition
    SD.refresh_days(spark, root, out, D("2025-01-03"), D("2025-01-04"))
    os.makedirs(os.path.join(out, "report_date=2025-01-03"))
    SD.refresh_days(spark, root, out, D("2025-01-03"), D("2025-01-04"))
    assert not os.path.exists(os.path.join(out, "report_date=2025-01-03"))

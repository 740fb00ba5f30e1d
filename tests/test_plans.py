"""Physical-plan properties that matter at scale.

Static broadcasts of fact tables are disabled (as if orders and lines were
terabytes) so the plans show the shuffles a cluster would run.  Dimension
joins keep their size-checked broadcast hints.
"""

import contextlib
import io

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"


@pytest.fixture()
def at_scale(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def plan(spark, name, mode="simple"):
    df = E.queries()[name](spark, SF)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def test_bounded_period_never_shuffles_the_line_table(at_scale):
    p = plan(at_scale, "packing_orders")
    lines = p.splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2
    # one exchange carries per-order partial sums (not lines), the other the
    # period's orders for the detail join
    below = [lines[i + 1] for i in exchanges]
    assert sum("partial_sum" in b for b in below) == 1
    assert any("hashpartitioning(o_id" in lines[i] for i in exchanges)
    assert "BroadcastHashJoin" in p and "LeftSemi" in p
    assert "Exchange rangepartitioning" in p  # the report's ORDER BY


def test_large_period_aggregates_on_the_join_partitioning(at_scale, monkeypatch):
    from ordertally.operators import joins as J

    monkeypatch.setattr(J, "ORDERS_BROADCAST_BYTES", 0)  # as if the period had too many orders
    p = plan(at_scale, "packing_orders")
    assert "SortMergeJoin" in p
    # lines and order ids for the semi join, order details for the final join;
    # the per-order aggregate reuses the semi join's partitioning.
    assert p.count("Exchange hashpartitioning") == 3
    assert p.count("BroadcastHashJoin") == 3  # products, store, packer: size-checked dimensions


def test_packing_by_worker_has_no_row_expansion(at_scale):
    p = plan(at_scale, "packing_by_worker")
    assert "Expand" not in p  # distinct aggregates done as grouped steps
    assert "SortAggregate" not in p


def test_product_totals_uses_hash_aggregation_only(at_scale):
    p = plan(at_scale, "product_totals")
    assert "SortAggregate" not in p and "HashAggregate" in p


def test_period_filter_reaches_the_scan(at_scale):
    p = plan(at_scale, "customer_orders", "formatted")
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)" in p
    assert "LessThan(o_orderdate,1996-07-01T00:00)" in p


def test_daily_range_condition_reaches_the_scan(at_scale):
    p = plan(at_scale, "daily_product_totals", "formatted")
    assert "GreaterThanOrEqual(o_orderdate,1998-02-25T00:00)" in p
    assert "LessThan(o_orderdate,1998-03-18T00:00)" in p


def test_zone_report_prunes_columns_and_aggregates_before_dimensions(at_scale):
    p = plan(at_scale, "zone_store_totals", "formatted")
    orders_schema = [line for line in p.splitlines() if line.startswith("ReadSchema: struct<o_orderkey")][0]
    assert "o_orderpriority" not in orders_schema
    assert "o_custkey" in orders_schema  # city is derived from the customer key in the fixture
    simple = plan(at_scale, "zone_store_totals")
    assert simple.count("Exchange hashpartitioning") == 2  # (store, city) pre-aggregate, then (store, zone)


def test_product_totals_exchanges_partial_rows_once(at_scale):
    p = plan(at_scale, "product_totals")
    exchanges = [line for line in p.splitlines() if "Exchange hashpartitioning" in line]
    of_lines = [line for line in exchanges if "product_id" in line or "order_id" in line]
    assert len(of_lines) == 1 and "order_id" not in of_lines[0]


def test_size_checks_send_no_rows_to_one_task(at_scale):
    from ordertally.operators import joins as J
    from ordertally.sources.fixtures import fixture_tables

    t = fixture_tables(at_scale, SF)
    seen = []
    first = type(t["orders"]).first
    try:
        type(t["orders"]).first = lambda self: (seen.append(self), first(self))[1]
        assert J.fits_broadcast(t["orders"].select("id", "sum"))
    finally:
        type(t["orders"]).first = first
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        seen[0].explain()
    assert "LocalLimit" not in buf.getvalue() and "partial_count" in buf.getvalue()


def test_coupon_orders_scan_the_table_once(spark, tmp_path):
    """Records that tasks read while the report runs, by the table's own row count."""
    from pyspark.sql import functions as F

    from ordertally.operators.sorting import sorted_desc

    spark.range(50_000).withColumn("v", F.col("id") % 7).write.parquet(str(tmp_path / "t"))
    seen = spark.sparkContext.accumulator(0)
    table = spark.read.parquet(str(tmp_path / "t"))

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = table.mapInArrow(count, table.schema)
    sorted_desc(rows, "id", settle="id").write.format("noop").mode("overwrite").save()
    assert seen.value == 50_000
    sorted_desc(rows, "v", ties=["id"], spread_ties=True).write.format("noop").mode("overwrite").save()
    assert seen.value == 100_000


def test_spread_ties_balances_a_repeated_sort_key(spark):
    from pyspark.sql import functions as F

    from ordertally.operators.sorting import sorted_desc

    df = spark.range(0, 60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("order_id"), F.lit(1).alias("product_id")
    )
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keep the 8 range partitions visible
    try:
        plain = sorted_desc(df, "order_id", ties=["product_id"]).rdd.glom().map(len).collect()
        spread = sorted_desc(df, "order_id", ties=["product_id"], spread_ties=True)
        sizes = spread.rdd.glom().map(len).collect()
        keys = [r["order_id"] for r in spread.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert max(plain) >= 20_000  # the hot key lands in one partition
    assert max(sizes) < 15_000  # spread over several
    assert keys == sorted(keys, reverse=True)

"""Report semantics on tiny hand-made tables (NULLs, ties, edges)."""

from decimal import Decimal

import pytest
from tables import D, M, make_tables

from ordertally.params import ReportParams
from ordertally.plans import reports as R

P = ReportParams("2025-01-01", "2025-01-07", "2025-01-01")


def collect(df):
    return [r.asDict() for r in df.collect()]


def test_period_is_inclusive_at_both_ends(spark):
    t = make_tables(spark, orders=[
        {"id": 1, "delivery_date": D("2025-01-01")},
        {"id": 2, "delivery_date": D("2025-01-07")},
        {"id": 3, "delivery_date": D("2025-01-08")},
        {"id": 4, "delivery_date": D("2024-12-31")},
    ])
    got = sorted(r["order_id"] for r in collect(R.coupon_orders(t, P)))
    assert got == [1, 2]


def test_status_and_store_deny_lists_drop_nulls(spark):
    t = make_tables(spark, orders=[
        {"id": 1, "status": None},
        {"id": 2, "status": 4},
        {"id": 3, "status": 11},
        {"id": 4, "store_id": None},
        {"id": 5, "store_id": 84},
        {"id": 6},
    ])
    assert [r["order_id"] for r in collect(R.coupon_orders(t, P))] == [6]


def test_coupon_orders_sorted_by_id_desc(spark):
    t = make_tables(spark, orders=[{"id": i, "coupons": "C" if i % 2 else None} for i in range(1, 6)])
    assert [r["order_id"] for r in collect(R.coupon_orders(t, P))] == [5, 4, 3, 2, 1]


def test_new_customers_split_by_phone_and_cutoff(spark):
    t = make_tables(spark, orders=[
        {"id": 1, "customer_id": 7, "phone": "1", "delivery_date": D("2025-01-03")},
        {"id": 2, "customer_id": 7, "phone": "2", "delivery_date": D("2025-01-04")},
        {"id": 3, "customer_id": 7, "phone": "2", "delivery_date": D("2025-01-05")},
        {"id": 4, "customer_id": 8, "delivery_date": D("2025-01-01")},
        {"id": 5, "customer_id": 9, "status": 1},
    ])
    p = ReportParams("2025-01-01", "2025-01-07", "2025-01-02")
    got = collect(R.new_customers(t, p))
    assert [(r["customer_id"], r["phone"], r["number_of_orders"]) for r in got] == [(7, "2", 2), (7, "1", 1)]
    assert got[0]["store_name"] == "north"


def test_new_customers_default_cutoff_keeps_everyone(spark):
    t = make_tables(spark, orders=[{"id": 1, "customer_id": 7}, {"id": 2, "customer_id": 8}])
    assert len(collect(R.new_customers(t, P))) == 2


def test_customer_orders_representative_and_order(spark):
    t = make_tables(spark, orders=[
        {"id": 5, "customer_id": 1, "phone": "late", "sum": M(10)},
        {"id": 2, "customer_id": 1, "phone": "early", "sum": M(20)},
        {"id": 3, "customer_id": 2, "phone": "x", "sum": M(1)},
        {"id": 4, "customer_id": 3, "phone": "y", "sum": M(1)},
    ])
    got = collect(R.customer_orders(t, P))
    assert [r["customer_id"] for r in got] == [1, 2, 3]  # count desc, then id
    assert got[0]["phone"] == "early"
    assert got[0]["avg_sum"] == 15.0
    assert got[0]["order_count"] == 2


def test_recent_customers_subset_of_customer_orders(spark):
    t = make_tables(spark, orders=[
        {"id": 1, "customer_id": 1, "delivery_date": D("2025-01-02")},
        {"id": 2, "customer_id": 2, "delivery_date": D("2025-01-06")},
    ])
    p = ReportParams("2025-01-01", "2025-01-07", "2025-01-05")
    recent = {r["customer_id"] for r in collect(R.recent_customers(t, p))}
    everyone = {r["customer_id"] for r in collect(R.customer_orders(t, p))}
    assert recent == {2} and recent <= everyone


def test_packing_orders_needs_lines_product_store_and_keeps_unknown_packer(spark):
    t = make_tables(
        spark,
        orders=[
            {"id": 1, "packing_worker_id": None},
            {"id": 2, "packing_worker_id": 9},
            {"id": 3},  # no lines
            {"id": 4, "store_id": 99},  # unknown store
            {"id": 5},  # only a line with unknown product
        ],
        lines=[
            {"order_id": 1, "product_id": 1, "quantity": 3},
            {"order_id": 1, "product_id": 2, "quantity": 4},
            {"order_id": 2, "product_id": 1},
            {"order_id": 4, "product_id": 1},
            {"order_id": 5, "product_id": 77},
        ],
    )
    got = {r["order_id"]: r for r in collect(R.packing_orders(t, P))}
    assert set(got) == {1, 2}
    assert got[1]["total_quantity"] == 7 and got[1]["type_1_quantity"] == 3
    assert got[1]["packer_first_name"] is None and got[2]["packer_first_name"] is None


def test_packing_by_worker_distinct_sum_and_null_group(spark):
    t = make_tables(
        spark,
        orders=[
            {"id": 1, "packing_worker_id": 1, "sum": M(10)},
            {"id": 2, "packing_worker_id": 1, "sum": M(10)},  # equal total counts once
            {"id": 3, "packing_worker_id": None, "sum": M(7)},
        ],
        lines=[
            {"order_id": 1, "quantity": 1},
            {"order_id": 1, "quantity": 2},
            {"order_id": 2, "quantity": 5},
            {"order_id": 3, "quantity": 1},
        ],
    )
    got = collect(R.packing_by_worker(t, P))
    assert [r["packing_worker_id"] for r in got] == [1, None]  # by line count desc
    w1 = got[0]
    assert (w1["order_count"], w1["quantity"], w1["distinct_sum"]) == (2, 8, Decimal("10.00"))
    assert w1["first_name"] == "W1"
    assert got[1]["distinct_sum"] == Decimal("7.00") and got[1]["first_name"] is None


def test_missing_lines_inner_packer_and_store_list(spark):
    t = make_tables(
        spark,
        orders=[
            {"id": 1},
            {"id": 2, "packing_worker_id": None},
            {"id": 3, "store_id": 82},
            {"id": 4, "packing_worker_id": 9},
        ],
        lines=[
            {"order_id": 1, "quantity_needed": 5, "quantity": 3},
            {"order_id": 1, "quantity_needed": 5, "quantity": 5},
            {"order_id": 2, "quantity_needed": 5, "quantity": 3},
            {"order_id": 3, "quantity_needed": 5, "quantity": 3},
            {"order_id": 4, "quantity_needed": 5, "quantity": 3},
        ],
    )
    got = collect(R.missing_lines(t, P))
    assert [(r["order_id"], r["missing_quantity"], r["delivered_quantity"]) for r in got] == [(1, 2, 3)]


def test_product_totals_values_and_order_price(spark):
    t = make_tables(
        spark,
        orders=[{"id": 10}, {"id": 11}],
        lines=[
            {"order_id": 11, "product_id": 1, "quantity_needed": 1, "quantity": 1, "unit_price": M(3)},
            {"order_id": 10, "product_id": 1, "quantity_needed": 2, "quantity": 1, "unit_price": M(6)},
            {"order_id": 10, "product_id": 1, "quantity_needed": 1, "quantity": 1, "unit_price": M(5)},
        ],
        products=[{"id": 1}, {"id": 2, "category_id": 99}],
    )
    got = collect(R.product_totals(t, P))
    assert len(got) == 1
    r = got[0]
    assert r["order_price"] == Decimal("5.00")  # lowest order id, then lowest price
    assert r["avg_unit_price"] == pytest.approx(14 / 3)
    assert r["quantity_ordered"] == 4 and r["total_ordered"] == Decimal("20.00")
    assert r["category_name"] == "fruit"


def test_zone_reports_unmatched_city_and_empty_zone(spark):
    t = make_tables(
        spark,
        orders=[
            {"id": 1, "city": "TLV", "sum": M(5)},
            {"id": 2, "city": "TLV", "sum": M(6), "store_id": 84},
            {"id": 3, "city": "HFA"},  # zone description ''
            {"id": 4, "city": "EILAT"},  # no such city
            {"id": 5, "city": None},
        ],
    )
    store_zone = collect(R.zone_store_totals(t, P))
    assert sorted((r["store_id"], r["zone"], r["order_count"]) for r in store_zone) == [(81, "center", 1), (84, "center", 1)]
    zones = collect(R.zone_totals(t, P))
    assert [(r["zone"], r["order_count"], r["sum_total"], r["store_id"]) for r in zones] == [
        ("center", 1, Decimal("5.00"), 81)
    ]


def test_zone_join_multiplies_for_duplicate_city_names(spark):
    t = make_tables(spark, orders=[{"id": 1, "city": "TLV", "sum": M(5)}],
                    cities=[("TLV", 1), ("TLV", 1)])
    got = collect(R.zone_store_totals(t, P))
    assert [(r["order_count"], r["sum_total"]) for r in got] == [(2, Decimal("10.00"))]


def test_daily_detail_filters(spark):
    t = make_tables(
        spark,
        orders=[
            {"id": 1, "delivery_window": 0, "status": 3},
            {"id": 2, "delivery_window": 2},
            {"id": 3, "status": 4},
            {"id": 4, "delivery_date": D("2025-01-03")},
        ],
        lines=[{"order_id": i} for i in range(1, 5)],
    )
    got = collect(R.daily_detail(t, "2025-01-02"))
    assert len(got) == 1 and got[0]["name"] == "apple"


def _daily_tables(spark):
    return make_tables(
        spark,
        orders=[
            {"id": 1, "delivery_date": D("2025-01-02"), "delivery_window": 1, "status": 4},  # evening, any status
            {"id": 2, "delivery_date": D("2025-01-03"), "delivery_window": 0, "status": 3},  # next morning
            {"id": 3, "delivery_date": D("2025-01-03"), "delivery_window": 0, "status": 4},  # wrong status
            {"id": 4, "delivery_date": D("2025-01-02"), "delivery_window": 0, "status": 0},  # belongs to Jan 1
            {"id": 5, "delivery_date": D("2025-01-02"), "delivery_window": 2, "status": 0},  # no window
        ],
        lines=[{"order_id": i, "quantity": i, "quantity_needed": 10 * i} for i in range(1, 6)],
    )


def test_daily_product_totals_literal_precedence(spark):
    t = _daily_tables(spark)
    got = collect(R.daily_product_totals(t, "2025-01-02"))
    assert [(r["report_date"], r["total_supplied"], r["quantity_needed"]) for r in got] == [(D("2025-01-02"), 3, 30)]
    assert got[0]["total_cost"] == Decimal("15.00")


def test_daily_product_totals_strict(spark):
    t = _daily_tables(spark)
    got = collect(R.daily_product_totals(t, "2025-01-02", strict_status=True))
    assert [r["total_supplied"] for r in got] == [2]


def test_daily_range_equals_union_of_single_days(spark):
    t = _daily_tables(spark)
    whole = sorted(tuple(r) for r in R.daily_product_totals(t, "2024-12-31", "2025-01-04").collect())
    parts = []
    for d in ["2024-12-31", "2025-01-01", "2025-01-02", "2025-01-03", "2025-01-04"]:
        parts += [tuple(r) for r in R.daily_product_totals(t, d).collect()]
    assert whole == sorted(parts)


def test_one_pass_days_equal_the_literal_per_day_condition(spark):
    from pyspark.sql import functions as F

    from ordertally.functions import predicates as Pr

    t = _daily_tables(spark)
    for strict in (False, True):
        for d in ["2025-01-01", "2025-01-02", "2025-01-03"]:
            o = t["orders"].filter(Pr.daily_rows(d, strict_status=strict)).select("id")
            lines = t["order_product"].join(o, F.col("order_id") == F.col("id"))
            literal = lines.groupBy("product_id").agg(F.sum("quantity").alias("total_supplied"))
            one_pass = R.daily_product_totals(t, d, strict_status=strict).select("product_id", "total_supplied")
            assert sorted(literal.collect()) == sorted(one_pass.collect()), (d, strict)


def test_zone_collation_option(spark):
    t = make_tables(spark, orders=[{"id": 1, "city": "tlv"}])
    assert R.zone_store_totals(t, P).count() == 0
    got = R.zone_store_totals(t, P, collation="UTF8_LCASE").collect()
    assert [(r["zone"], r["order_count"]) for r in got] == [("center", 1)]


def test_daily_status_marks_empty_days(spark):
    t = _daily_tables(spark)
    got = collect(R.daily_status(t, "2025-01-01", "2025-01-03"))
    assert sorted((r["report_date"], r["n_rows"], r["status"]) for r in got) == [
        (D("2025-01-01"), 1, "OK"), (D("2025-01-02"), 1, "OK"), (D("2025-01-03"), 0, "No Data"),
    ]


def test_reversed_range_raises(spark):
    t = _daily_tables(spark)
    with pytest.raises(ValueError):
        R.daily_product_totals(t, "2025-01-03", "2025-01-01")
    with pytest.raises(ValueError):
        ReportParams("2025-01-03", "2025-01-01")


def test_order_of_rows_ties_included(spark):
    day = [D("2025-01-02"), D("2025-01-05"), D("2025-01-02"), D("2025-01-05")]
    t = make_tables(
        spark,
        orders=[{"id": i + 1, "delivery_date": d, "customer_id": 9 - i, "city": ["TLV", "HFA"][i % 2]} for i, d in enumerate(day)],
        lines=[
            {"order_id": 1, "product_id": 2, "quantity_needed": 5, "quantity": 1},
            {"order_id": 1, "product_id": 1, "quantity_needed": 5, "quantity": 1},
            {"order_id": 2, "product_id": 1, "quantity_needed": 3, "quantity": 1},
            {"order_id": 3, "product_id": 2, "quantity_needed": 3, "quantity": 1},
            {"order_id": 4, "product_id": 1, "quantity_needed": 1, "quantity": 0},
            {"order_id": 4, "product_id": 1, "quantity_needed": 1, "quantity": 0},
        ],
        city_groups=[(1, "center"), (2, "north")],
    )
    # R2: newest day first, then the lower id
    assert [r["order_id"] for r in collect(R.packing_orders(t, P))] == [2, 4, 1, 3]
    # R4: highest order first, then the product; equal lines both appear
    got = [(r["order_id"], r["product_id"]) for r in collect(R.missing_lines(t, P))]
    assert got == [(4, 1), (4, 1), (3, 2), (2, 1), (1, 1), (1, 2)]
    # R5: larger quantity first
    assert [(r["product_id"], r["quantity_ordered"]) for r in collect(R.product_totals(t, P))] == [(1, 10), (2, 8)]
    # R9: equal counts by customer; R12: equal counts by zone
    assert [r["customer_id"] for r in collect(R.recent_customers(t, P))] == [6, 7, 8, 9]
    assert [r["zone"] for r in collect(R.zone_totals(t, P))] == ["center", "north"]


def test_identical_rows_all_come_back(spark):
    from ordertally.operators import sorting

    df = spark.createDataFrame([(1, "a")] * 10 + [(2, None)] * 4 + [(None, "b")], "k int, v string")
    got = [tuple(r) for r in sorting.sorted_desc(df, "k", spread_ties=True).collect()]
    assert got == [(2, None)] * 4 + [(1, "a")] * 10 + [(None, "b")]


def test_order_price_of_null_and_negative_prices(spark):
    t = make_tables(
        spark, orders=[{"id": 5}, {"id": 10**15}],
        lines=[
            {"order_id": 5, "product_id": 1, "unit_price": None}, {"order_id": 5, "product_id": 1, "unit_price": M("-2.5")},
            {"order_id": 10**15, "product_id": 1, "unit_price": M("-9")},
            {"order_id": 5, "product_id": 2, "unit_price": None}, {"order_id": 10**15, "product_id": 2, "unit_price": M(3)},
        ],
    )
    got = {r["product_id"]: r["order_price"] for r in collect(R.product_totals(t, P))}
    assert got == {1: M("-2.50"), 2: None}

"""Bundle runner, sinks, shared inputs, failure isolation and JDBC."""

import os
import tempfile

from tables import D, make_tables
from pyspark.sql import functions as F

import __spark_entry__ as E
from ordertally.plans import bundle as Bn
from ordertally.plans import reports as R
from ordertally.plans.catalog import WEEKLY_REPORTS
from ordertally.sinks import writers as W
from ordertally.sources import fixtures as FX
from ordertally.sources import jdbc as JD
from ordertally.sources import parquet as PQ

SF = "/root/testdata/sf0.001"


def _canon(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def test_shared_inputs_give_same_results(spark):
    t = FX.fixture_tables(spark, SF)
    plain = {n: _canon(df) for n, df in Bn.build_reports(t, E.PERIOD).items()}
    for mode in ("persist", "table"):
        shared = Bn.shared_inputs(t, E.PERIOD, mode)
        try:
            got = {n: _canon(df) for n, df in Bn.build_reports(shared.tables, E.PERIOD).items()}
        finally:
            shared.release()
        assert got == plain, mode


def test_run_all_writes_every_report_and_manifest(spark):
    t = FX.fixture_tables(spark, SF)
    out = tempfile.mkdtemp(prefix="ordertally-bundle-")
    manifest = {r["report"]: r for r in Bn.run_all(spark, t, E.PERIOD, out=out).collect()}
    assert set(manifest) == set(WEEKLY_REPORTS)
    assert all(r["status"] == "ok" for r in manifest.values())
    for name in WEEKLY_REPORTS:
        path = W.report_path(out, name, E.PERIOD.label)
        assert spark.read.parquet(path).count() == manifest[name]["n_rows"]
    assert manifest["customer_orders"]["n_rows"] == manifest["yearly_orders"]["n_rows"]  # same period


def test_run_all_isolates_a_failing_report(spark):
    base = FX.fixture_tables(spark, SF)
    t = Bn.Overlay(base, workers=base["workers"].drop("first_name"))  # breaks worker-name reports
    out = tempfile.mkdtemp(prefix="ordertally-fail-")
    manifest = {r["report"]: r for r in Bn.run_all(spark, t, E.PERIOD, out=out, share=None).collect()}
    failed = {n for n, r in manifest.items() if r["status"] == "failed"}
    err = spark.read.parquet(W.report_path(out, "packing_orders", E.PERIOD.label))
    assert err.columns == ["error"] and err.count() == 1
    assert failed == {"packing_orders", "packing_by_worker", "missing_lines"}
    assert manifest["customer_orders"]["status"] == "ok"
    assert "first_name" in manifest["packing_orders"]["error"]


def test_default_run_isolates_a_missing_table(spark):
    base = FX.fixture_tables(spark, SF)
    t = {n: base[n] for n in FX.FIXTURE_SQL if not n.startswith("order_product")}
    manifest = {r["report"]: r for r in Bn.run_all(spark, t, E.PERIOD).collect()}
    failed = {n for n, r in manifest.items() if r["status"] == "failed"}
    assert failed == {"shared_inputs", "packing_orders", "packing_by_worker", "missing_lines", "product_totals"}
    assert manifest["zone_totals"]["status"] == "ok"


def test_new_orders_are_seen_by_the_next_run(spark, tmp_path):
    from tables import D, make_tables

    first = make_tables(spark, orders=[{"id": 1, "delivery_date": D("2025-01-02")}], lines=[{"order_id": 1}])
    PQ.write_tables(first, str(tmp_path))
    t = PQ.load_tables(spark, str(tmp_path))
    p = E.ReportParams("2025-01-01", "2025-01-31")
    assert [r.order_id for r in R.packing_orders(t, p).collect()] == [1]
    more = make_tables(spark, orders=[{"id": 99, "delivery_date": D("2025-01-03")}], lines=[{"order_id": 99}])
    PQ.write_tables(more, str(tmp_path), mode="append", names=["orders", "order_product"])
    for table in t.values():
        table.sparkSession.catalog.refreshByPath(str(tmp_path))
    t = PQ.load_tables(spark, str(tmp_path))
    assert sorted(r.order_id for r in R.packing_orders(t, p).collect()) == [1, 99]


def test_staged_tables_can_be_staged_again(spark, tmp_path):
    from tables import make_tables

    t = make_tables(spark, orders=[{"id": 1}], lines=[{"order_id": 1}])
    PQ.write_tables(t, str(tmp_path / "a"))
    PQ.write_tables(PQ.load_tables(spark, str(tmp_path / "a")), str(tmp_path / "b"))
    again = PQ.load_tables(spark, str(tmp_path / "b"))["order_product"]
    assert again.columns.count("delivery_date") == 1 and again.count() == 1


def test_quantities_and_created_date_keep_their_types(spark, tmp_path):
    from decimal import Decimal

    import pytest
    from pyspark.sql import functions as F

    from tables import D, make_tables
    from ordertally import schema as S

    t = make_tables(spark, orders=[{"id": 1, "delivery_date": D("2025-01-02")}], lines=[{"order_id": 1}])
    weighed = t["order_product"].withColumns({c: F.lit("0.750").cast("decimal(12,3)") for c in S.QUANTITIES})
    stamped = t["orders"].withColumn("created_date", F.to_timestamp(F.lit("2025-01-01 13:45:00")))
    t = {**t, "orders": S.conform(stamped, S.ORDERS), "order_product": S.conform(weighed, S.ORDER_PRODUCT)}
    PQ.write_tables(t, str(tmp_path))
    for tables in (t, PQ.load_tables(spark, str(tmp_path))):
        p = E.ReportParams("2025-01-01", "2025-01-31")
        row = R.product_totals(tables, p).first()
        assert row.quantity_ordered == Decimal("0.750") and row.total_billed == Decimal("3.75")
        assert R.packing_orders(tables, p).first().type_1_quantity == Decimal("0.750")
        assert R.coupon_orders(tables, p).first().created_date.hour == 13
    with pytest.raises(Exception, match="quantity does not fit"):
        S.conform(weighed.withColumn("quantity", F.lit(0.1234)), S.ORDER_PRODUCT).collect()
    with pytest.raises(Exception, match="sum does not fit"):
        S.conform(t["orders"].withColumn("sum", F.lit("1.239").cast("decimal(12,3)")), S.ORDERS).collect()


def test_sorted_report_written_in_order(spark):
    t = FX.fixture_tables(spark, SF)
    out = tempfile.mkdtemp(prefix="ordertally-sorted-")
    path = os.path.join(out, "c")
    n = W.write_report(R.customer_orders(t, E.PERIOD), path, single_file=True)
    counts = [r["order_count"] for r in spark.read.parquet(path).collect()]
    assert n == len(counts) and counts == sorted(counts, reverse=True)


def test_run_daily_partitions_by_date_and_marks_empty_days(spark):
    t = make_tables(spark, orders=[{"id": 1, "delivery_date": D("2025-01-02")}], lines=[{"order_id": 1}])
    out = tempfile.mkdtemp(prefix="ordertally-daily-")
    status = {r["report_date"]: r["status"] for r in Bn.run_daily(spark, t, "2025-01-01", "2025-01-03", out=out).collect()}
    assert status == {D("2025-01-01"): "No Data", D("2025-01-02"): "OK", D("2025-01-03"): "No Data"}
    written = os.listdir(W.report_path(out, "daily_product_totals", "2025-01-01_to_2025-01-03"))
    assert "report_date=2025-01-02" in written


def test_staged_layout_gives_same_reports_and_prunes_lines(spark):
    import contextlib
    import io

    t = FX.fixture_tables(spark, SF)
    root = tempfile.mkdtemp(prefix="ordertally-tables-")
    PQ.write_tables({k: t[k] for k in FX.FIXTURE_SQL}, root)
    loaded = PQ.load_tables(spark, root)
    assert "delivery_date" in loaded["order_product"].columns
    assert os.path.isdir(os.path.join(root, "order_product", "delivery_date=1996-01-02"))
    for name, df in Bn.build_reports(loaded, E.PERIOD).items():
        assert _canon(df) == _canon(Bn.build_reports(t, E.PERIOD, names=[name])[name]), name
    assert _canon(R.daily_product_totals(loaded, FX.RANGE_START, FX.RANGE_END)) == _canon(
        R.daily_product_totals(t, FX.RANGE_START, FX.RANGE_END)
    )
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        R.packing_orders(loaded, E.PERIOD).explain(mode="formatted")
    scans = [b for b in buf.getvalue().split("\n\n") if "order_product" in b and "Scan parquet" in b]
    assert scans and all("PartitionFilters: [isnotnull(delivery_date" in b for b in scans)


def test_jdbc_source_partitioned_read(spark):
    url = "jdbc:derby:memory:ordertally;create=true"
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    t = FX.fixture_tables(spark, SF)
    orders = t["orders"].select("id", "store_id", "delivery_date", "status", "sum")
    orders.write.format("jdbc").options(url=url, dbtable="ORDERS_T", **driver).mode("overwrite").save()
    df = JD.load_jdbc(spark, url, "ORDERS_T", driver, partition_column="ID", lower=1, upper=6000,
                      num_partitions=3, require_credentials=False)
    assert df.rdd.getNumPartitions() == 3
    assert df.count() == orders.count()
    pushed = df.filter(F.col("STATUS") == 3)
    assert pushed.count() == orders.filter("status = 3").count()


def test_jdbc_tables_split_reads_and_report(spark):
    url = "jdbc:derby:memory:ordertally2;create=true"
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    t = FX.fixture_tables(spark, SF)
    for name in FX.FIXTURE_SQL:  # upper-case columns, as the database folds unquoted names
        upper = t[name].toDF(*[c.upper() for c in t[name].columns])
        upper.write.format("jdbc").options(url=url, dbtable=name, **driver).mode("overwrite").save()
    db = JD.load_jdbc_tables(spark, url, driver, require_credentials=False, split=4)
    assert db["orders"].rdd.getNumPartitions() == 4
    assert db["order_product"].rdd.getNumPartitions() == 4
    assert _canon(R.packing_orders(db, E.PERIOD)) == _canon(R.packing_orders(t, E.PERIOD))


def test_jdbc_refuses_missing_settings(spark):
    import pytest

    with pytest.raises(ValueError, match="user, password"):
        JD.load_jdbc(spark, "jdbc:derby:memory:x", "T")
    with pytest.raises(ValueError, match="go together"):
        JD.load_jdbc(spark, "jdbc:derby:memory:x", "T", partition_column="ID", require_credentials=False)


SOME = ["packing_orders", "packing_by_worker", "missing_lines", "coupon_orders"]


def test_a_repeated_id_fails_only_the_reports_that_rely_on_it(spark, tmp_path):
    base = FX.fixture_tables(spark, SF)  # nothing built yet
    broken = Bn.Overlay(base, workers=base["workers"].unionByName(base["workers"]))
    for share, names in (("persist", list(WEEKLY_REPORTS)), ("table", SOME), (None, SOME)):
        manifest = {r["report"]: r for r in Bn.run_all(spark, broken, E.PERIOD, share=share, names=names).collect()}
        assert list(manifest) == names
        assert {n for n, r in manifest.items() if r["status"] == "failed"} == {"packing_orders", "packing_by_worker"}
        assert "workers.id is not unique" in manifest["packing_orders"]["error"]
    fresh = FX.fixture_tables(spark, SF)
    manifest = Bn.run_all(spark, fresh, E.PERIOD, names=["coupon_orders"], validate=True, share=None).collect()
    assert manifest[0]["status"] == "ok"


def test_a_dimension_without_its_id_fails_only_its_reports(spark):
    base = FX.fixture_tables(spark, SF)
    broken = Bn.Overlay(base, workers=base["workers"].drop("id"))
    for share, names in (("persist", list(WEEKLY_REPORTS)), ("table", SOME), (None, SOME)):
        manifest = {r["report"]: r for r in Bn.run_all(spark, broken, E.PERIOD, share=share, names=names).collect()}
        assert list(manifest) == names
        assert {n for n, r in manifest.items() if r["status"] == "failed"} == {
            "packing_orders", "packing_by_worker", "missing_lines"
        }
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_order_ids_are_checked_in_each_reports_own_period(spark):
    old, new = {"id": 1, "delivery_date": D("2020-05-05")}, {"id": 2, "delivery_date": D("2025-01-02")}
    t = make_tables(spark, orders=[old, old, new], lines=[{"order_id": 2}])
    p = E.ReportParams("2025-01-01", "2025-01-31")
    names = ["packing_orders", "packing_by_worker", "customer_orders"]
    for share in ("persist", None):
        rows = Bn.run_all(spark, t, p, names=names, share=share).collect()
        assert {r["status"] for r in rows} == {"ok"}, share
        own = {"packing_by_worker": E.ReportParams("2020-01-01", "2020-12-31")}
        rows = Bn.run_all(spark, t, p, names=names, share=share, periods=own).collect()
        assert [r["status"] for r in rows] == ["ok", "failed", "ok"]
        assert "orders.id is not unique" in rows[1]["error"]


def test_a_failed_rerun_keeps_the_former_result(spark, tmp_path):
    base = FX.fixture_tables(spark, SF)
    run = lambda t: {r["report"]: r for r in Bn.run_all(spark, t, E.PERIOD, out=str(tmp_path), names=["packing_orders"]).collect()}
    path = W.report_path(str(tmp_path), "packing_orders", E.PERIOD.label)
    assert run(base)["packing_orders"]["status"] == "ok"
    former = _canon(spark.read.parquet(path))
    assert run(Bn.Overlay(base, workers=base["workers"].drop("first_name")))["packing_orders"]["status"] == "failed"
    assert _canon(spark.read.parquet(path)) == former
    assert "first_name" in spark.read.parquet(path + "_error").first()["error"]
    assert run(base)["packing_orders"]["status"] == "ok" and not os.path.exists(path + "_error")


def test_a_write_that_fails_halfway_leaves_the_former_result(spark, tmp_path, monkeypatch):
    import pytest

    path = str(tmp_path / "r")
    good = spark.range(100)
    assert W.write_report(good, path) == 100
    halfway = spark.range(0, 200, 1, 8).select(F.when(F.col("id") < 150, F.col("id")).otherwise(F.raise_error(F.lit("broken"))).alias("id"))
    for write in (W.write_report, lambda df, p: W.write_by_date(df, p, date_col="id")):
        with pytest.raises(Exception, match="broken"):
            write(halfway.select("id", F.lit(1).alias("v")) if write is not W.write_report else halfway, path)
        assert W.read_report(spark, path, good.schema).count() == 100
        assert os.listdir(tmp_path) == ["r"]

    # A run that dies between the two renames: the note leads to the former result, and the next write mends it.
    rename, calls = W.rename_path, []

    def dies(spark, source, target):
        calls.append(target)
        if len(calls) == 2:
            raise RuntimeError("killed")
        rename(spark, source, target)

    monkeypatch.setattr(W, "rename_path", dies)
    with pytest.raises(RuntimeError, match="killed"):
        W.write_report(spark.range(7), path)
    assert not os.path.exists(path) and W.read_report(spark, path, good.schema).count() == 100
    monkeypatch.setattr(W, "rename_path", rename)
    assert W.write_report(spark.range(9), path) == 9
    assert spark.read.parquet(path).count() == 9 and not os.path.exists(tmp_path / "_former-r")


def test_dropped_rows_equal_anti_joins(spark):
    t = make_tables(
        spark,
        orders=[{"id": 1}, {"id": 2, "store_id": 99}, {"id": 3, "packing_worker_id": 77}, {"id": 4, "packing_worker_id": None}, {"id": 5, "city": "??"}],
        lines=[{"order_id": i, "product_id": p, "quantity": 1} for i in range(1, 6) for p in (1, 2, 500)],
    )
    p = E.ReportParams("2025-01-01", "2025-01-31")
    names = ["packing_orders", "missing_lines", "product_totals", "zone_store_totals", "customer_orders"]
    plain = {n: _canon(df) for n, df in Bn.build_reports(t, p, names).items()}
    rows = {r["report"]: r for r in Bn.run_all(spark, t, p, names=names, count_drops=True).collect()}
    assert {n: r["n_rows"] for n, r in rows.items()} == {n: len(x) for n, x in plain.items()}
    o, l = t["orders"], t["order_product"]
    lines = l.join(o.filter("store_id not in (82, 84, 85)").select("id", "store_id", "packing_worker_id"), l.order_id == F.col("id"))
    anti = lambda df, dim, key: df.join(t[dim].select(F.col("id").alias("_d")), F.col(key) == F.col("_d"), "left_anti").count()
    known = lines.join(t["products"].select(F.col("id").alias("_p")), F.col("product_id") == F.col("_p"))
    in_store = known.join(t["store"].select(F.col("id").alias("_s")), F.col("store_id") == F.col("_s"))
    assert rows["missing_lines"]["dropped"] == {
        "products": anti(lines, "products", "product_id"),
        "store": anti(known, "store", "store_id"),
        "workers": anti(in_store, "workers", "packing_worker_id"),
    }
    assert rows["packing_orders"]["dropped"] == {"products": 5, "store": 1}
    assert rows["product_totals"]["dropped"] == {"products": 1, "categories": 0}
    assert rows["zone_store_totals"]["dropped"] == {"cities": 1, "store": 1}
    assert rows["customer_orders"]["dropped"] == {}
    assert Bn.run_all(spark, t, p, names=["coupon_orders"]).first()["dropped"] is None


def test_a_run_measures_each_side_once(spark, monkeypatch):
    from ordertally.operators import joins as J

    monkeypatch.setattr(J, "STATISTICS_BYTES", 0)
    seen, measure = [], J.side_bytes
    monkeypatch.setattr(J, "side_bytes", lambda df: (seen.append(df), measure(df))[1])
    t = FX.fixture_tables(spark, SF)
    names = ["packing_orders", "packing_by_worker", "missing_lines", "zone_totals", "zone_store_totals"]
    Bn.run_all(spark, t, E.PERIOD, share=None, names=names).count()
    assert seen and not any(a is not b and a.sameSemantics(b) for i, a in enumerate(seen) for b in seen[:i])
    monkeypatch.setattr(J, "STATISTICS_BYTES", 4 << 20)
    seen.clear()
    Bn.run_all(spark, t, E.PERIOD, share=None, names=names).count()
    assert seen == []  # file sizes settle it

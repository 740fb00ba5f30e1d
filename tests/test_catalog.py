"""Named views, SQL text, database catalog and ranges, bucketed tables, daily partials, collations."""

import contextlib
import datetime as dt
import io
import os

import pytest
from pyspark.sql import functions as F
from tables import D, M, make_tables

import __spark_entry__ as E
from ordertally import schema as S
from ordertally.cli import main
from ordertally.operators import joins as J
from ordertally.params import ReportParams
from ordertally.plans import bundle as Bn
from ordertally.plans import partials as PT
from ordertally.plans import reports as R
from ordertally.plans.catalog import REPORTS, run_report
from ordertally.sources import catalog as C
from ordertally.sources import fixtures as FX
from ordertally.sources import jdbc as JD
from ordertally.sources import parquet as PQ

SF = "/root/testdata/sf0.001"
DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
P = ReportParams("2025-01-01", "2025-01-31")


def canon(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def plan(df, mode="simple"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def derby(spark, name, tables):
    url = f"jdbc:derby:memory:{name};create=true"
    for table, df in tables.items():
        upper = df.toDF(*[c.upper() for c in df.columns])
        upper.write.format("jdbc").options(url=url, dbtable=table, **DERBY).mode("overwrite").save()
    return url


# --- views and SQL text -----------------------------------------------------------


def test_views_of_plain_staged_and_database_tables_are_alike(spark, tmp_path):
    t = FX.fixture_tables(spark, SF)
    plain = {n: t[n] for n in S.SCHEMAS}
    plain["orders"] = plain["orders"].filter("delivery_date BETWEEN DATE'1996-01-01' AND DATE'1996-01-20'")
    plain["order_product"] = plain["order_product"].join(plain["orders"].select(F.col("id").alias("order_id")), "order_id", "left_semi")
    t = plain
    PQ.write_tables(plain, str(tmp_path / "staged"), lines_by_date=True)
    for n, df in plain.items():
        df.write.parquet(str(tmp_path / "plain" / n))
    url = derby(spark, "views", plain)
    JD.jdbc_catalog(spark, "viewsdb", url, DERBY)
    C.register_parquet(spark, "shop_plain", str(tmp_path / "plain"))
    C.register_parquet(spark, "shop_staged", str(tmp_path / "staged"))
    found = {r["tableName"].lower(): r["tableName"] for r in spark.sql("SHOW TABLES IN viewsdb.APP").collect()}
    text = "SELECT status, COUNT(*) AS n, SUM(sum) AS total FROM orders WHERE delivery_date >= :start GROUP BY status"
    want = canon(t["orders"].filter("delivery_date >= DATE'1996-01-01'").groupBy("status").agg(F.count("id"), F.sum("sum")))
    for schema in ("shop_plain", "shop_staged"):
        assert canon(C.run_sql(spark, text, E.PERIOD, schema=schema)) == want
        tables = C.tables_of(spark, schema)
        assert set(tables) == set(S.SCHEMAS)
        for n in S.SCHEMAS:
            assert [(f.name, f.dataType) for f in tables[n].schema.fields][: len(S.SCHEMAS[n])] == [
                (f.name, f.dataType) for f in S.SCHEMAS[n].fields
            ]
            assert C.unique_key(spark, schema, n) == S.UNIQUE_KEYS.get(n)
        assert canon(R.packing_orders(tables, E.PERIOD)) == canon(R.packing_orders(t, E.PERIOD))
    assert "PartitionFilters: [isnotnull(delivery_date" in plan(R.packing_orders(C.tables_of(spark, "shop_staged"), E.PERIOD), "formatted")
    db = JD.load_catalog_tables(spark, "viewsdb", "APP")
    assert set(found) >= set(S.SCHEMAS)
    assert canon(R.packing_orders(db, E.PERIOD)) == canon(R.packing_orders(t, E.PERIOD))
    assert canon(C.run_sql(spark, text.replace("orders", "{orders}"), E.PERIOD, tables=db)) == want
    assert spark.catalog.currentDatabase() == "default"


def test_views_check_types_and_columns(spark, tmp_path):
    t = make_tables(spark, orders=[{"id": 1}])
    t["store"].select(F.col("id").cast("string").alias("id"), "name").write.parquet(str(tmp_path / "store"))
    C.register_parquet(spark, "odd", str(tmp_path), ["store"])
    assert [r["id"] for r in spark.table("odd.store").orderBy("id").collect()] == [81, 82, 84, 85]
    t["store"].select(F.lit("x1").alias("id"), "name").write.mode("overwrite").parquet(str(tmp_path / "store"))
    C.register_parquet(spark, "odd", str(tmp_path), ["store"])
    with pytest.raises(Exception, match="id does not fit int"):
        spark.table("odd.store").collect()
    t["store"].select("id").write.mode("overwrite").parquet(str(tmp_path / "store"))
    with pytest.raises(ValueError, match="store lacks name"):
        C.register_parquet(spark, "odd", str(tmp_path), ["store"])


def test_parameters_are_values_not_text(spark):
    t = make_tables(spark, orders=[{"id": 1, "first_name": "x' OR '1'='1"}, {"id": 2, "first_name": "y"}])
    got = C.run_sql(spark, "SELECT id FROM {orders} WHERE first_name = :who", tables=t, who="x' OR '1'='1").collect()
    assert [r["id"] for r in got] == [1]


def test_run_report_by_name(spark):
    t = FX.fixture_tables(spark, SF)
    short = ReportParams(FX.RANGE_START, FX.RANGE_START)
    for name in REPORTS:
        assert run_report(name, t, short).columns
    assert canon(run_report("recent_customers", t, E.PERIOD)) == canon(R.recent_customers(t, E.PERIOD))
    assert canon(run_report("daily_detail", t, short)) == canon(R.daily_detail(t, FX.RANGE_START))
    with pytest.raises(ValueError, match="unknown report"):
        run_report("nothing", t, short)


def test_cli_report_and_sql(spark, tmp_path):
    query = tmp_path / "by_status.sql"
    query.write_text("SELECT status, COUNT(*) AS n FROM orders WHERE delivery_date BETWEEN :start AND :end GROUP BY status")
    given = ["--fixtures", SF, "--out", str(tmp_path), "--start", FX.PERIOD_START, "--end", FX.PERIOD_END]
    assert main(["sql", "--file", str(query), *given], spark) == 0
    label = E.PERIOD.label
    t = FX.fixture_tables(spark, SF)
    want = canon(t["orders"].filter(F.col("delivery_date").between(FX.PERIOD_START, FX.PERIOD_END)).groupBy("status").count())
    assert canon(spark.read.parquet(str(tmp_path / f"by_status_{label}"))) == want
    assert main(["report", "coupon_orders", *given], spark) == 0
    assert canon(spark.read.parquet(str(tmp_path / f"coupon_orders_{label}"))) == canon(R.coupon_orders(t, E.PERIOD))
    assert main(["report", "nothing", *given], spark) == 2


# --- database -----------------------------------------------------------------------


def test_size_checks_run_in_the_database(spark, monkeypatch):
    t = make_tables(spark, orders=[{"id": i, "delivery_date": D("2025-01-02")} for i in range(50)])
    url = derby(spark, "sizes", t)
    JD.jdbc_catalog(spark, "sizesdb", url, DERBY)
    db = JD.load_catalog_tables(spark, "sizesdb", "APP")
    seen, first = [], type(db["orders"]).first
    monkeypatch.setattr(type(db["orders"]), "first", lambda self: (seen.append(self), first(self))[1])
    assert J.is_small(R.period_orders(db, P).select("id", "sum"))
    shown = plan(seen[0], "formatted")
    assert "PushedAggregates: [COUNT(*)]" in shown and "DELIVERY_DATE >= " in shown and "NOT (STATUS IN" in shown, shown
    assert "HashAggregate" not in shown  # the one row is the result
    # A side with texts is counted there first, and not fetched if the count alone is beyond the bound.
    seen.clear()
    assert not J.is_small(db["orders"], max_bytes=100)
    assert len(seen) == 1 and "PushedAggregates: [COUNT(*)]" in plan(seen[0], "formatted")


def test_ranges_of_equal_rows(spark):
    crowd = list(range(1, 2001)) + [10**9, 10**9 + 1, 2 * 10**12]  # equal-width ranges would hold all rows but three in one
    days = [D("2025-01-01") + dt.timedelta(days=i % 40) for i in range(400)] + [D("2025-03-01")] * 300
    spark.createDataFrame([(i,) for i in crowd] + [(None,)], "ID long").write.format("jdbc").options(
        url="jdbc:derby:memory:ranges;create=true", dbtable="CROWD", **DERBY).mode("overwrite").save()
    spark.createDataFrame([(d, i) for i, d in enumerate(days)] + [(None, -1)], "DAY date, N int").write.format("jdbc").options(
        url="jdbc:derby:memory:ranges", dbtable="DAYS", **DERBY).mode("overwrite").save()
    url = "jdbc:derby:memory:ranges"
    df = JD.load_jdbc_in_ranges(spark, url, "CROWD", "ID", 8, DERBY)
    sizes = df.rdd.glom().map(len).collect()
    assert sum(sizes) == len(crowd) + 1 and max(sizes) <= 2 * len(crowd) / 8 and len(sizes) <= 9
    assert sorted(r[0] for r in df.filter("ID IS NOT NULL").collect()) == crowd
    df = JD.load_jdbc_in_ranges(spark, url, "DAYS", "DAY", 7, DERBY)
    sizes = df.rdd.glom().map(len).collect()
    assert sum(sizes) == 701 and sorted(sizes)[-1] <= 300 and sorted(sizes)[-2] <= 200
    few = JD.load_jdbc_days(spark, url, "DAYS", "DAY", D("2025-01-05"), D("2025-01-10"), 3, DERBY)
    assert few.count() == sum(D("2025-01-05") <= d <= D("2025-01-10") for d in days)
    spark.createDataFrame([], "ID long").write.format("jdbc").options(url=url, dbtable="NOTHING", **DERBY).mode("overwrite").save()
    assert JD.load_jdbc_in_ranges(spark, url, "NOTHING", "ID", 4, DERBY).count() == 0


# --- bucketed tables ------------------------------------------------------------------


def test_long_periods_on_bucketed_tables_exchange_no_lines(spark, tmp_path, monkeypatch):
    t = FX.fixture_tables(spark, SF)
    PQ.write_bucketed({n: t[n] for n in S.SCHEMAS}, "buckets", str(tmp_path), buckets=4)
    monkeypatch.setattr(J, "ORDERS_BROADCAST_BYTES", 0)  # a long period
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for tables in (C.tables_of(spark, "buckets"), PQ.register_bucketed(spark, "buckets_again", str(tmp_path), 4)):
            for build in (R.packing_orders, R.packing_by_worker):
                df = build(tables, E.PERIOD)
                shown = plan(df)
                exchanges = [x for x in shown.splitlines() if "Exchange hashpartitioning" in x]
                assert not any("order_id" in x or "o_id" in x or "_oid" in x for x in exchanges), shown
                assert "SortMergeJoin" in shown
                assert canon(df) == canon(build(t, E.PERIOD))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --- daily partials ---------------------------------------------------------------------


def test_customer_reports_from_daily_partials(spark, tmp_path):
    t, root = FX.fixture_tables(spark, SF), str(tmp_path)
    want = canon(R.customer_orders(t, E.YEAR))
    assert canon(PT.customer_orders_from_days(spark, t, root, E.YEAR)) == want  # nothing closed yet
    PT.close_days(spark, t, root, "1996-01-01", "1996-06-30")
    PT.close_days(spark, t, root, "1996-08-01", "1996-08-31")
    PT.close_days(spark, t, root, "1996-06-01", "1996-06-30")  # again
    assert canon(PT.customer_orders_from_days(spark, t, root, E.YEAR)) == want
    assert canon(PT.recent_customers_from_days(spark, t, root, E.YEAR)) == canon(R.recent_customers(t, E.YEAR))
    assert canon(PT.customer_orders_from_days(spark, t, root, E.PERIOD)) == canon(R.customer_orders(t, E.PERIOD))
    # Only open days are read from the orders.
    shown = plan(PT.customer_orders_from_days(spark, t, root, E.YEAR), "formatted")
    assert "1996-07-01" in shown and "1996-09-01" in shown and "GreaterThanOrEqual(o_orderdate,1996-01-01" not in shown
    closed = plan(PT.customer_orders_from_days(spark, t, root, E.PERIOD), "formatted")
    assert "orders.parquet" not in closed and "PartitionFilters: [isnotnull(delivery_date" in closed


def test_partials_of_null_customers_and_totals(spark, tmp_path):
    orders = [
        {"id": 9, "customer_id": None, "delivery_date": D("2025-01-02"), "first_name": "late"},
        {"id": 3, "customer_id": None, "delivery_date": D("2025-01-04"), "first_name": None, "sum": None},
        {"id": 4, "customer_id": 5, "delivery_date": D("2025-01-04"), "sum": None},
    ]
    t = make_tables(spark, orders=orders)
    PT.close_days(spark, t, str(tmp_path), "2025-01-01", "2025-01-03")
    got = canon(PT.customer_orders_from_days(spark, t, str(tmp_path), P))
    assert got == canon(R.customer_orders(t, P)) and len(got) == 2
    # A closed day is not read again; closing it once more takes in what came late.
    t = make_tables(spark, orders=orders + [{"id": 1, "customer_id": 5, "delivery_date": D("2025-01-03")}])
    assert canon(PT.customer_orders_from_days(spark, t, str(tmp_path), P)) == got
    PT.close_days(spark, t, str(tmp_path), "2025-01-03", "2025-01-03")
    assert canon(PT.customer_orders_from_days(spark, t, str(tmp_path), P)) == canon(R.customer_orders(t, P)) != got


# --- names in two steps -----------------------------------------------------------------


def test_names_of_customers_in_two_steps(spark, monkeypatch):
    t = FX.fixture_tables(spark, SF)
    want = [canon(build(t, E.YEAR)) for build in (R.customer_orders, R.recent_customers)]
    nulls = make_tables(spark, orders=[{"id": 2, "customer_id": None, "first_name": None}, {"id": 1, "customer_id": None, "phone": None}])
    few = canon(R.customer_orders(nulls, P))
    assert "SortAggregate" in plan(R.customer_orders(t, E.YEAR))
    monkeypatch.setattr(R, "TWO_STEP_BYTES", 0)
    assert "SortAggregate" not in plan(R.customer_orders(t, E.YEAR))
    assert [canon(build(t, E.YEAR)) for build in (R.customer_orders, R.recent_customers)] == want
    assert canon(R.customer_orders(nulls, P)) == few


# --- collations ----------------------------------------------------------------------------


def collated_tables(spark):
    names = [("Ann", "Bee", "TLV"), ("ANN", "bee", "tlv"), ("ann", "BEE", "Tlv"), ("Cy", "Dee", "HFA"), ("cy", "Dee", "hfa"), ("Cy", "dee", "??")]
    orders = [
        {"id": i + 1, "customer_id": 1 if n[0].lower() == "ann" else 2, "first_name": n[0], "last_name": n[1], "city": n[2], "sum": M(i + 1)}
        for i, n in enumerate(names)
    ]
    return make_tables(spark, orders=orders, cities=[("tLv", 1), ("Hfa", 2)], city_groups=[(1, "Center"), (2, "CENTER")])


def test_reports_by_collation_equal_a_case_insensitive_database(spark, tmp_path):
    import duckdb

    t = collated_tables(spark)
    con = duckdb.connect()
    for n in ("orders", "store", "cities", "city_groups"):
        t[n].write.parquet(str(tmp_path / n))
        con.execute(f"CREATE TABLE {n} AS SELECT * FROM read_parquet('{tmp_path}/{n}/*.parquet')")
    asked = {
        "new_customers": (
            "SELECT customer_id, MIN(first_name) AS first_name, MIN(last_name) AS last_name, COUNT(*) AS number_of_orders FROM orders "
            "GROUP BY customer_id, store_id, first_name COLLATE NOCASE, last_name COLLATE NOCASE, phone COLLATE NOCASE"),
        "zone_store_totals": (
            "SELECT store_id, MIN(description) AS zone, COUNT(*) AS order_count, CAST(SUM(sum) AS DECIMAL(18,2)) AS sum_total FROM orders "
            "JOIN cities ON orders.city COLLATE NOCASE = cities.name COLLATE NOCASE JOIN city_groups g ON g.id = city_group_id "
            "GROUP BY store_id, description COLLATE NOCASE"),
        "zone_totals": (
            "SELECT MIN(description) AS zone, COUNT(*) AS order_count, CAST(SUM(sum) AS DECIMAL(18,2)) AS sum_total FROM orders "
            "JOIN cities ON orders.city COLLATE NOCASE = cities.name COLLATE NOCASE JOIN city_groups g ON g.id = city_group_id "
            "WHERE store_id <> 84 GROUP BY description COLLATE NOCASE"),
    }
    out = str(tmp_path / "out")
    manifest = Bn.run_all(spark, t, P, out=out, names=list(asked), collation="UTF8_LCASE").collect()
    assert {r["status"] for r in manifest} == {"ok"}
    for name, sql in asked.items():
        res = con.execute(sql)
        columns = [d[0] for d in res.description]
        want = sorted(tuple(str(v) for v in r) for r in res.fetchall())
        assert canon(spark.read.parquet(os.path.join(out, f"{name}_{P.label}")).select(columns)) == want, name
    PQ.write_tables(t, str(tmp_path / "staged"))
    given = ["--tables", str(tmp_path / "staged"), "--start", "2025-01-01", "--end", "2025-01-31", "--collation", "UTF8_LCASE"]
    assert main(["report", "zone_totals", "--out", str(tmp_path / "cli"), *given], spark) == 0
    assert spark.read.parquet(str(tmp_path / "cli" / f"zone_totals_{P.label}")).count() == 1
    assert R.zone_totals(t, P).count() == 0 and R.new_customers(t, P).count() == 6  # bytes, by default

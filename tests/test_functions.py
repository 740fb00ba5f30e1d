"""Date parsing, parameters, predicates and joins."""

import pytest
from tables import D, make_tables
from pyspark.sql import functions as F

from ordertally import schema as S
from ordertally.functions import dates as FD
from ordertally.operators import joins as J
from ordertally.params import ReportParams, day_list, last_n_days, yesterday


def test_last_n_days_spans_eight_calendar_days():
    p = last_n_days("2025-11-13")
    assert (p.start, p.end, p.cutoff) == (D("2025-11-06"), D("2025-11-13"), D("2025-11-06"))
    assert len(day_list(p.start, p.end)) == 8


def test_yesterday_and_cutoff_default():
    assert yesterday("2025-03-01") == D("2025-02-28")
    assert ReportParams("2025-01-01", "2025-01-31").cutoff == D("2025-01-01")
    assert ReportParams("2025-01-01", "2025-01-31", "2025-01-20").label == "2025-01-01_to_2025-01-31"


@pytest.mark.parametrize(
    "text,expected",
    [
        ("111125", "2025-11-11"),
        (" 111125 ", "2025-11-11"),
        ("11.11.25", "2025-11-11"),
        ("1.1.25", "2025-01-01"),
        ("11/11/25", "2025-11-11"),
        ("010175", "1975-01-01"),
        ("010168", "2068-01-01"),
        ("010169", "1969-01-01"),
        ("11125", "2025-01-11"),
        ("1125", "2025-01-01"),
        ("45125", None),
        ("\t111125\n", "2025-11-11"),
        ("310225", None),
        ("junk", None),
        ("2025-11-11", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_day(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    got = df.select(FD.parse_day("s").alias("d")).first()["d"]
    assert got == (D(expected) if expected else None)


def test_parse_range(spark):
    df = spark.createDataFrame([("111125-131125",), ("111125",), ("1.1.25 - 3/1/25-x",), ("bad-111125",)], "s string")
    start, end = FD.parse_range("s")
    got = [tuple(r) for r in df.select(start, end).collect()]
    assert got == [
        (D("2025-11-11"), D("2025-11-13")),
        (D("2025-11-11"), D("2025-11-11")),
        (D("2025-01-01"), D("2025-01-03")),
        (None, D("2025-11-11")),
    ]


def test_date_spine(spark):
    got = [r[0] for r in FD.date_spine(spark, "2025-02-27", "2025-03-02").collect()]
    assert got == [D("2025-02-27"), D("2025-02-28"), D("2025-03-01"), D("2025-03-02")]
    with pytest.raises(ValueError):
        FD.date_spine(spark, "2025-03-02", "2025-02-27")


def test_worker_joins_left_inner_and_roles(spark):
    t = make_tables(spark, orders=[
        {"id": 1, "packing_worker_id": 1, "dispatcher_worker_id": 2},
        {"id": 2, "packing_worker_id": None},
        {"id": 3, "packing_worker_id": 9},
    ])
    o = t["orders"].select("id", "packing_worker_id", "dispatcher_worker_id")
    left = {r["id"]: r["first_name"] for r in J.with_worker(o, t["workers"], how="left").collect()}
    assert left == {1: "W1", 2: None, 3: None}
    inner = [r["id"] for r in J.with_worker(o, t["workers"], how="inner").collect()]
    assert inner == [1]
    disp = J.with_worker(o, t["workers"], role="dispatcher", prefix="d_").filter("id = 1").first()
    assert disp["d_first_name"] == "W2"


def test_zone_join_with_collation(spark):
    t = make_tables(spark, orders=[{"id": 1, "city": "tlv"}])
    o = t["orders"].select("id", "city")
    assert J.with_zone(o, t["cities"], t["city_groups"]).count() == 0
    got = J.with_zone(o, t["cities"], t["city_groups"], collation="UTF8_LCASE").collect()
    assert [(r["id"], r["zone"]) for r in got] == [(1, "center")]


def test_sides_are_broadcast_by_bytes(spark):
    side = spark.range(100).selectExpr("id", "if(id = 0, null, 'xx') as name")
    assert J.side_bytes(side) == 100 * 32 + 99 * 2 and J.side_bytes(side.limit(0)) == 0
    assert J.fits_broadcast(side, 3398) and not J.fits_broadcast(side, 3397)


def test_unique_key_check(spark):
    t = make_tables(spark, workers=[(1, "a", "b"), (1, "c", "d")])
    with pytest.raises(ValueError, match="workers.id"):
        S.assert_unique_keys(t)
    S.assert_unique_keys(make_tables(spark))


def test_conform_casts_to_declared_types(spark):
    df = spark.createDataFrame([(1, "x")], "id int, name string")
    out = S.conform(df, S.STORE)
    assert out.schema == S.STORE or [f.dataType for f in out.schema] == [f.dataType for f in S.STORE]


def test_sum_types_are_fixed(spark):
    from ordertally.functions import aggregates as A

    df = spark.createDataFrame([(1, 2)], "a int, b int").select(
        F.lit(1).cast("decimal(12,2)").alias("m"), "a", "b"
    )
    out = df.agg(A.money_sum("m").alias("s"), A.qty_sum("a").alias("q"), A.exact_avg("m").alias("v"))
    assert [f.dataType.simpleString() for f in out.schema] == ["decimal(18,2)", "bigint", "double"]


def _python_day(text):
    """Python's own parse of the three accepted formats, tried in order."""
    import datetime as dt

    for fmt in ("%d%m%y", "%d.%m.%y", "%d/%m/%y"):
        try:
            return dt.datetime.strptime(text.strip(), fmt).date()
        except ValueError:
            continue
    return None


def test_parse_day_agrees_with_python_on_random_dates(spark):
    import datetime as dt
    import random

    rng = random.Random(7)
    texts = []
    for _ in range(600):
        d = dt.date(1950, 1, 1) + dt.timedelta(days=rng.randrange(0, 100 * 365))
        yy = f"{d.year % 100:02d}"
        day = f"{d.day:02d}" if rng.random() < 0.5 else str(d.day)
        month = f"{d.month:02d}" if rng.random() < 0.5 else str(d.month)
        form = rng.choice(["plain", "dots", "slashes"])
        if form == "plain":
            text = f"{d.day:02d}{d.month:02d}{yy}"
        else:
            text = f"{day}{'.' if form == 'dots' else '/'}{month}{'.' if form == 'dots' else '/'}{yy}"
        texts.append(rng.choice(["", " "]) + text + rng.choice(["", "  "]))
    texts += ["".join(rng.choice("0123456789") for _ in range(rng.choice([3, 4, 5, 5, 6, 7]))) for _ in range(400)]
    texts += ["\t11125\n", "310225", "290223", "290224", "00.01.25", "1.13.25", "12-12-25", "121225x"]
    df = spark.createDataFrame([(x,) for x in texts], "s string")
    got = {r["s"]: r["d"] for r in df.select("s", FD.parse_day("s").alias("d")).collect()}
    assert got == {x: _python_day(x) for x in texts}


def test_next_day_and_format_day(spark):
    df = spark.createDataFrame([(D("2024-02-28"),), (D("2024-12-31"),)], "d date")
    got = [tuple(r) for r in df.select(FD.next_day("d"), FD.format_day(FD.next_day("d"))).collect()]
    assert got == [(D("2024-02-29"), "2024-02-29"), (D("2025-01-01"), "2025-01-01")]

"""Every registered query against its SQL oracle on random tables.

The tables are small but hostile: NULLs in every nullable column, unknown
stores/workers/products/categories/cities, a city name listed twice, an
empty and a NULL zone description, equal order totals, and hot keys (one
order, one customer, one product and one worker each hold about a third of
their table).  Both engines read the same Parquet files.
"""

import collections
import datetime as dt
import decimal
import os
import tempfile

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
from ordertally import schema as S

DAY0 = [dt.date(1995, 12, 20) + dt.timedelta(days=i) for i in range(200)]  # around the period
DAY1 = [dt.date(1998, 2, 18) + dt.timedelta(days=i) for i in range(35)]  # around the daily range


def _money(rng, lo=1, hi=500):
    return decimal.Decimal(int(rng.integers(lo * 100, hi * 100))).scaleb(-2)


def _maybe(rng, value, p_null=0.08):
    return None if rng.random() < p_null else value


def random_tables(seed: int) -> dict[str, list[tuple]]:
    rng = np.random.default_rng(seed)
    n_orders, n_lines, n_products = 240, 900, 40
    days = DAY0 + DAY1
    orders = []
    for oid in range(1, n_orders + 1):
        hot = rng.random() < 0.33
        cust = 7 if hot else int(rng.integers(1, 30))
        orders.append((
            oid, oid + 500000, _maybe(rng, cust, 0.03),
            _maybe(rng, int(rng.integers(80, 87))),
            _maybe(rng, dt.date(1998, 2, 25) if rng.random() < 0.08 else days[int(rng.integers(len(days)))], 0.03),
            days[int(rng.integers(len(days)))],
            _maybe(rng, int(rng.integers(0, 3))), _maybe(rng, int(rng.integers(0, 13))),
            str(rng.choice(["O", "F", "P"])), f"DHL{oid}", bool(rng.random() < 0.1),
            _maybe(rng, _money(rng) if rng.random() < 0.7 else decimal.Decimal("100.00")),  # equal totals
            _money(rng, 0, 5), _money(rng, 0, 5), _maybe(rng, "C5", 0.6),
            _maybe(rng, f"F{cust}"), _maybe(rng, f"L{cust % 5}"), _maybe(rng, f"05{cust}-{oid % 2}"),
            _maybe(rng, str(rng.choice(["TLV", "HFA", "JLM", "BSH", "EILAT"]))),
            7 if hot and rng.random() < 0.9 else _maybe(rng, int(rng.integers(1, 12)), 0.15),
            _maybe(rng, int(rng.integers(0, 6))),
        ))
    lines = []
    for _ in range(n_lines):
        oid = 5 if rng.random() < 0.33 else int(rng.integers(1, n_orders + 20))  # hot order; some orphans
        pid = 3 if rng.random() < 0.33 else int(rng.integers(1, n_products + 5))  # hot product; unknown ids
        need = _maybe(rng, int(rng.integers(0, 6)), 0.05)
        got = _maybe(rng, int(rng.integers(0, 6)), 0.05)
        lines.append((oid, _maybe(rng, pid, 0.02), need, got, _maybe(rng, got), _maybe(rng, int(rng.integers(0, 2))),
                      _money(rng, 1, 50)))
    products = [
        (pid, f"p{pid}", _maybe(rng, f"H p{pid}"), f"p{pid} {pid % 7}", _maybe(rng, _money(rng, 1, 50), 0.05),
         _money(rng, 1, 40), _maybe(rng, int(rng.integers(1, 8)), 0.05), _maybe(rng, int(rng.integers(0, 3))),
         _maybe(rng, str(rng.choice(["fruit", "veg", "dairy"]))))
        for pid in range(1, n_products + 1)
    ]
    categories = [(c, f"cat{c}") for c in range(1, 7)]  # category 7 is unknown
    store = [(i, f"store{i}") for i in range(81, 87)]  # store 80 is unknown
    workers = [(i, _maybe(rng, f"W{i}"), f"X{i}") for i in range(1, 9)]  # workers 9-11 unknown
    cities = [("TLV", 1), ("HFA", 2), ("JLM", 3), ("BSH", 4), ("TLV", 1)]  # TLV twice; EILAT missing
    city_groups = [(1, "center"), (2, ""), (3, None), (4, "south")]
    eighths = lambda q: None if q is None else decimal.Decimal(q) / 8
    by_weight = [(*x[:2], *map(eighths, x[2:6]), x[6]) for x in lines]
    return {
        "orders": orders, "order_product": lines, "order_product_weight": by_weight, "products": products, "categories": categories,
        "store": store, "workers": workers, "cities": cities, "city_groups": city_groups,
    }


SCHEMAS = {
    **S.SCHEMAS,
    "order_product_weight": S.T.StructType(
        [S.T.StructField(f.name, S.WEIGHT if f.name in S.QUANTITIES else f.dataType) for f in S.ORDER_PRODUCT.fields]
    ),
}


def _norm(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (decimal.Decimal, dt.date)):
        return str(v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], collections.Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module", params=[11, 29])
def random_world(spark, request):
    seed = request.param
    data = random_tables(seed)
    root = tempfile.mkdtemp(prefix="ordertally-random-")
    con = duckdb.connect()
    tables = {}
    for name, rows in data.items():
        path = os.path.join(root, name)
        spark.createDataFrame(rows, SCHEMAS[name]).write.parquet(path)
        tables[name] = spark.read.schema(SCHEMAS[name]).parquet(path)
        con.execute(f"CREATE VIEW f_{name} AS SELECT * FROM read_parquet('{path}/*.parquet')")
    return tables, con


@pytest.mark.parametrize("name", sorted(E.BUILDERS))
def test_query_matches_oracle_on_random_tables(spark, random_world, name):
    tables, con = random_world
    df = E.BUILDERS[name](spark, tables)
    scols, srows = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_bodies("given")[name])
    dcols, drows = _canon([d[0] for d in res.description], res.fetchall())
    assert scols == dcols
    assert srows == drows
    assert sum(srows.values()) > 0  # the random tables exercise every query

"""Explicit schemas of the eight order-reporting tables and key checks.

The source system never declares types; these are fixed here so that money
stays exact (DECIMAL) and dates are calendar days (DATE).  Two kinds of
column keep the type their source has: quantities are whole numbers (INT) or
weights (DECIMAL(12,3)), and ``created_date`` is a DATE or a TIMESTAMP.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
WEIGHT = T.DecimalType(12, 3)
QUANTITIES = ("quantity_needed", "quantity", "quantity_delivered", "quantity_replaceable")

ORDERS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("wp_id", T.LongType(), True),
        T.StructField("customer_id", T.LongType(), True),
        T.StructField("store_id", T.IntegerType(), True),
        T.StructField("delivery_date", T.DateType(), True),
        T.StructField("created_date", T.DateType(), True),
        T.StructField("delivery_window", T.IntegerType(), True),
        T.StructField("status", T.IntegerType(), True),
        T.StructField("clearing_status", T.StringType(), True),
        T.StructField("dhl_package_number", T.StringType(), True),
        T.StructField("is_deleted", T.BooleanType(), True),
        T.StructField("sum", MONEY, True),
        T.StructField("discount_sum", MONEY, True),
        T.StructField("discount_promotions", MONEY, True),
        T.StructField("coupons", T.StringType(), True),
        T.StructField("first_name", T.StringType(), True),
        T.StructField("last_name", T.StringType(), True),
        T.StructField("phone", T.StringType(), True),
        T.StructField("city", T.StringType(), True),
        T.StructField("packing_worker_id", T.LongType(), True),
        T.StructField("dispatcher_worker_id", T.LongType(), True),
    ]
)

ORDER_PRODUCT = T.StructType(
    [
        T.StructField("order_id", T.LongType(), False),
        T.StructField("product_id", T.LongType(), True),
        T.StructField("quantity_needed", T.IntegerType(), True),
        T.StructField("quantity", T.IntegerType(), True),
        T.StructField("quantity_delivered", T.IntegerType(), True),
        T.StructField("quantity_replaceable", T.IntegerType(), True),
        T.StructField("unit_price", MONEY, True),
    ]
)

PRODUCTS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("name", T.StringType(), True),
        T.StructField("name_heb", T.StringType(), True),
        T.StructField("name_weight", T.StringType(), True),
        T.StructField("price", MONEY, True),
        T.StructField("low_cost_price", MONEY, True),
        T.StructField("category_id", T.IntegerType(), True),
        T.StructField("packing_action", T.IntegerType(), True),
        T.StructField("product_list", T.StringType(), True),
    ]
)

CATEGORIES = T.StructType(
    [T.StructField("id", T.IntegerType(), False), T.StructField("name", T.StringType(), True)]
)

STORE = T.StructType(
    [T.StructField("id", T.IntegerType(), False), T.StructField("name", T.StringType(), True)]
)

WORKERS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("first_name", T.StringType(), True),
        T.StructField("last_name", T.StringType(), True),
    ]
)

CITIES = T.StructType(
    [
        T.StructField("name", T.StringType(), True),
        T.StructField("city_group_id", T.IntegerType(), True),
    ]
)

CITY_GROUPS = T.StructType(
    [
        T.StructField("id", T.IntegerType(), False),
        T.StructField("description", T.StringType(), True),
    ]
)

SCHEMAS: dict[str, T.StructType] = {
    "orders": ORDERS,
    "order_product": ORDER_PRODUCT,
    "products": PRODUCTS,
    "categories": CATEGORIES,
    "store": STORE,
    "workers": WORKERS,
    "cities": CITIES,
    "city_groups": CITY_GROUPS,
}

# Keys the reports rely on being unique (aggregate-before-join and the
# dropped dispatcher join are only equivalent to the source SQL if they are).
UNIQUE_KEYS: dict[str, str] = {
    "orders": "id",
    "products": "id",
    "categories": "id",
    "store": "id",
    "workers": "id",
    "city_groups": "id",
}


def resolved(schema: T.StructType, source: T.StructType) -> T.StructType:
    """``schema`` with quantities and ``created_date`` typed as ``source`` has them."""
    types = {f.name.lower(): f.dataType for f in source.fields}

    def of(f: T.StructField) -> T.DataType:
        have = types.get(f.name)
        if f.name in QUANTITIES and have is not None and not isinstance(have, T.IntegralType):
            return WEIGHT
        if f.name == "created_date" and isinstance(have, (T.TimestampType, T.TimestampNTZType)):
            return have
        return f.dataType

    return T.StructType([T.StructField(f.name, of(f), f.nullable) for f in schema.fields])


def always_exact(have: T.DataType, want: T.DataType) -> bool:
    """Whether every value of one type is one of the other."""
    if have == want or isinstance(have, T.NullType):
        return True
    sizes = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
    if isinstance(have, T.IntegralType):
        if isinstance(want, T.IntegralType):
            return sizes[type(have)] <= sizes[type(want)]
        return isinstance(want, T.DecimalType) and sizes[type(have)] <= want.precision - want.scale
    if isinstance(have, T.DecimalType) and isinstance(want, T.DecimalType):
        return have.scale <= want.scale and have.precision - have.scale <= want.precision - want.scale
    return False


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast ``df`` to ``schema`` (column order and types; see ``resolved``).

    A value that its column's type cannot hold exactly fails the read with
    the column's name; nothing is rounded or cut.  Columns that need no such
    check stay plain casts, so filters on them are still pushed down.
    """
    have = {f.name.lower(): f.dataType for f in df.schema.fields}  # databases may fold names

    def cast(f: T.StructField):
        c = F.col(f.name)
        out = c.try_cast(f.dataType)
        if always_exact(have[f.name], f.dataType):
            return c.cast(f.dataType).alias(f.name)
        if isinstance(have[f.name], T.StringType):
            exact = out.isNotNull()
        else:
            exact = out.try_cast(have[f.name]) == c
        text = F.concat(F.lit(f"{f.name} does not fit {f.dataType.simpleString()}: "), c.cast("string"))
        return F.when(c.isNull() | exact, out).otherwise(F.raise_error(text).cast(f.dataType)).alias(f.name)

    return df.select([cast(f) for f in resolved(schema, df.schema).fields])


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once (empty when the key is unique).

    A distributed group-by, so it scales with the table; callers decide
    whether to ``.isEmpty()`` it or show the offenders.
    """
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def key_problems(tables: dict[str, DataFrame], names) -> dict[str, str]:
    """What is wrong with the declared unique keys of the named tables, by table name.

    A repeated key, a missing key column and a table that cannot be read each
    give their own message; tables without a problem are left out, and so are
    tables that are not there.  The dimensions are checked in one job; if that
    fails, one by one.
    """
    found: dict[str, str] = {}
    parts: dict[str, DataFrame] = {}
    for name in names:
        if name not in UNIQUE_KEYS:
            continue
        try:
            parts[name] = duplicate_keys(tables[name].select(F.col(UNIQUE_KEYS[name]).cast("string").alias("key")), "key").limit(1)
        except KeyError:
            continue
        except Exception as e:
            found[name] = f"{type(e).__name__}: {e}"

    def repeated(some: dict[str, DataFrame]) -> list[str]:
        every = None
        for name, df in some.items():
            one = df.select(F.lit(name).alias("name"))
            every = one if every is None else every.unionByName(one)
        return [] if every is None else [r["name"] for r in every.collect()]  # a row per table at most

    try:
        bad = repeated(parts)
    except Exception:
        bad = []
        for name, df in parts.items():
            try:
                bad += repeated({name: df})
            except Exception as e:
                found[name] = f"{type(e).__name__}: {e}"
    found.update({name: f"ValueError: {name}.{UNIQUE_KEYS[name]} is not unique" for name in bad})
    return found


def assert_unique_keys(tables: dict[str, DataFrame]) -> None:
    """Raise ``ValueError`` if any declared unique key is duplicated."""
    for name, key in UNIQUE_KEYS.items():
        try:
            df = tables[name]  # lazy table dicts build a table on first access
        except KeyError:
            continue
        if not duplicate_keys(df, key).isEmpty():
            raise ValueError(f"{name}.{key} is not unique")

"""Test fixtures: the eight report tables derived from the generated TPC-H-like tables.

The SQL text below is the single definition of each fixture table.  Spark
runs it with DataFrame parameters (``spark.sql(text, orders=df)``); the
DuckDB oracle runs the same text as CTEs over its pre-registered views, so
both engines see identical inputs.  Money is DECIMAL(12,2), days are DATE.
"""

from __future__ import annotations

import os
import zlib

from pyspark.sql import DataFrame, SparkSession

from ordertally import schema as S

# Fixed fixture definitions (the text must stay valid in Spark and DuckDB).
FIXTURE_SQL: dict[str, str] = {
    "orders": """
SELECT o_orderkey AS id, o_orderkey + 500000 AS wp_id, o_custkey AS customer_id,
  CAST(80 + o_orderkey % 7 AS INT) AS store_id,
  CAST(o_orderdate AS DATE) AS delivery_date, CAST(o_orderdate AS DATE) AS created_date,
  CAST(o_orderkey % 3 AS INT) AS delivery_window, CAST(o_orderkey % 13 AS INT) AS status,
  o_orderstatus AS clearing_status, concat('DHL', CAST(o_orderkey AS VARCHAR(20))) AS dhl_package_number,
  o_orderkey % 17 = 0 AS is_deleted, CAST(o_totalprice AS DECIMAL(12,2)) AS sum,
  CAST(o_orderkey % 4 AS DECIMAL(12,2)) AS discount_sum,
  CAST(o_orderkey % 3 AS DECIMAL(12,2)) AS discount_promotions,
  CASE WHEN o_orderkey % 5 = 0 THEN 'C5' END AS coupons,
  concat('F', CAST(o_custkey AS VARCHAR(20))) AS first_name,
  concat('L', CAST(o_custkey % 50 AS VARCHAR(20))) AS last_name,
  concat('05', CAST(o_custkey AS VARCHAR(20)), '-', CAST(o_orderkey % 2 AS VARCHAR(20))) AS phone,
  concat('NATION_', CAST(o_custkey % 27 AS VARCHAR(20))) AS city,
  CASE WHEN o_orderkey % 12 > 8 THEN -(o_orderkey % 12) ELSE nullif(o_orderkey % 12, 0) END AS packing_worker_id, o_orderkey % 6 AS dispatcher_worker_id
FROM {orders}""",
    "order_product": """
SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INT) AS quantity_needed,
  greatest(CAST(l_quantity AS INT) - CASE WHEN l_returnflag = 'R' THEN l_linenumber ELSE 0 END, 0) AS quantity,
  greatest(CAST(l_quantity AS INT) - CASE WHEN l_returnflag = 'R' THEN l_linenumber ELSE 0 END, 0) AS quantity_delivered,
  l_linenumber % 2 AS quantity_replaceable, CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price
FROM {lineitem}""",
    # The same lines sold by weight: quantities with three places.
    "order_product_weight": """
SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity / 8 AS DECIMAL(12,3)) AS quantity_needed,
  CAST(greatest(l_quantity / 8 - CASE WHEN l_returnflag = 'R' THEN l_linenumber / 4 ELSE 0 END, 0) AS DECIMAL(12,3))
    AS quantity,
  CAST(greatest(l_quantity / 8 - CASE WHEN l_returnflag = 'R' THEN l_linenumber / 4 ELSE 0 END, 0) AS DECIMAL(12,3))
    AS quantity_delivered,
  CAST(l_linenumber % 2 AS DECIMAL(12,3)) AS quantity_replaceable,
  CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price
FROM {lineitem}""",
    "products": """
SELECT p_partkey AS id, p_name AS name, concat('H ', p_name) AS name_heb,
  concat(p_name, ' ', CAST(p_size AS VARCHAR(10))) AS name_weight,
  CAST(p_retailprice AS DECIMAL(12,2)) AS price,
  CAST(CAST(p_retailprice AS DECIMAL(12,2)) - 10 AS DECIMAL(12,2)) AS low_cost_price,
  CAST(substr(p_brand, 7) AS INT) AS category_id, p_size % 3 AS packing_action, p_type AS product_list
FROM {part}""",
    "categories": """
SELECT DISTINCT CAST(substr(p_brand, 7) AS INT) AS id, p_brand AS name FROM {part}""",
    "store": """
SELECT CAST(80 + s_suppkey AS INT) AS id, s_name AS name FROM {supplier}""",
    "workers": """
SELECT s_suppkey AS id, concat('W', CAST(s_suppkey AS VARCHAR(10))) AS first_name,
  concat('X', CAST(s_suppkey AS VARCHAR(10))) AS last_name
FROM {supplier}""",
    "cities": """
SELECT n_name AS name, n_regionkey AS city_group_id FROM {nation}""",
    "city_groups": """
SELECT r_regionkey AS id, CASE WHEN r_name = 'ASIA' THEN '' ELSE r_name END AS description FROM {region}""",
}

# Base table each fixture reads.
FIXTURE_SOURCE = {
    "orders": "orders",
    "order_product": "lineitem",
    "order_product_weight": "lineitem",
    "products": "part",
    "categories": "part",
    "store": "supplier",
    "workers": "supplier",
    "cities": "nation",
    "city_groups": "region",
}

# Report parameters used with these fixtures (FIXTURES.md).
PERIOD_START = "1996-01-01"
PERIOD_END = "1996-06-30"
PERIOD_CUTOFF = "1996-05-01"
DETAIL_DAY = "1998-02-25"
RANGE_START = "1998-02-25"
RANGE_END = "1998-03-16"


def base_path(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")


def fixture_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    src = FIXTURE_SOURCE[name]
    base = spark.read.parquet(base_path(sf_dir, src))
    df = spark.sql(FIXTURE_SQL[name], **{src: base})
    return S.conform(df, S.SCHEMAS[name.removesuffix("_weight")])


class FixtureTables(dict):
    """Table dict that builds each fixture table on first access."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._spark, self._dir = spark, sf_dir

    @property
    def sf_dir(self) -> str:
        return self._dir

    def __missing__(self, name: str) -> DataFrame:
        if name not in FIXTURE_SQL:
            raise KeyError(name)
        df = fixture_table(self._spark, self._dir, name)
        self[name] = df
        return df


def fixture_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The eight report tables over one scale-factor directory (lazy)."""
    return FixtureTables(spark, sf_dir)


def register_fixtures(spark: SparkSession, sf_dir: str) -> str:
    """The eight report tables over one scale-factor directory as views of a schema; returns its name."""
    from ordertally.sources.catalog import register, sql_source

    schema = f"report_fixtures_{zlib.crc32(os.path.abspath(sf_dir).encode()):08x}"
    texts = {}
    for name in S.SCHEMAS:
        base = FIXTURE_SOURCE[name]
        texts[name] = FIXTURE_SQL[name].format(**{base: f"parquet.`{base_path(sf_dir, base)}`"})
    register(spark, schema, {name: sql_source(spark, text) for name, text in texts.items()})
    return schema


def oracle_with_clause() -> str:
    """``WITH f_orders AS (...), ...`` for the DuckDB oracle queries."""
    parts = []
    for name, text in FIXTURE_SQL.items():
        body = text.format(**{FIXTURE_SOURCE[name]: FIXTURE_SOURCE[name]})
        parts.append(f"f_{name} AS ({body}\n)")
    return "WITH " + ",\n".join(parts) + "\n"

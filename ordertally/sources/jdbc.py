"""Relational source: read a report table from a database over JDBC.

Two ways in.  ``load_jdbc_tables`` reads tables in parallel ranges; where the
rows of an id or a day are uneven, ``equal_ranges`` has the database count them
and cuts ranges of about equal rows.  ``jdbc_catalog`` registers the database as
a Spark catalog, whose tables take whole aggregates to the database: a size
check then comes back as one row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ordertally import schema as S

REQUIRED = ("url", "user", "password")

# Connection-setting names of the source programs, and their
# database driver names mapped to JDBC URL schemes.
SETTING_NAMES = ("DB_DRIVER", "DB_USERNAME", "DB_PASSWORD", "DB_HOST", "DB_PORT", "DB_NAME")
JDBC_SCHEMES = {
    "mysql": "jdbc:mysql://{host}:{port}/{database}",
    "postgresql": "jdbc:postgresql://{host}:{port}/{database}",
    "mssql": "jdbc:sqlserver://{host}:{port};databaseName={database}",
}


def settings_to_jdbc(settings: dict) -> tuple[str, dict]:
    """``(url, props)`` from the source programs' six connection settings.

    ``DB_DRIVER`` may carry a client suffix (``mysql+pymysql``); only the
    database part picks the URL form.  Raises ``ValueError`` naming every
    missing setting, as the source programs refuse to start without them.
    """
    missing = [k for k in SETTING_NAMES if not settings.get(k)]
    if missing:
        raise ValueError(f"missing connection settings: {', '.join(missing)}")
    kind = settings["DB_DRIVER"].split("+", 1)[0].lower()
    if kind not in JDBC_SCHEMES:
        raise ValueError(f"unsupported database {settings['DB_DRIVER']!r}; use one of {sorted(JDBC_SCHEMES)}")
    url = JDBC_SCHEMES[kind].format(host=settings["DB_HOST"], port=settings["DB_PORT"], database=settings["DB_NAME"])
    return url, {"user": settings["DB_USERNAME"], "password": settings["DB_PASSWORD"]}


def load_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    props: dict | None = None,
    partition_column: str | None = None,
    lower=None,
    upper=None,
    num_partitions: int | None = None,
    require_credentials: bool = True,
) -> DataFrame:
    """Read ``table`` through JDBC as a DataFrame.

    Refuses to start when a connection setting is missing (the source
    program does the same before it connects).  Without
    ``partition_column`` the read is a single task; give a numeric or date
    column with bounds and ``num_partitions`` so the database is read in
    parallel ranges.  Filters on the result are pushed to the database.
    """
    opts = {"url": url, "dbtable": table, "fetchsize": str(FETCH_ROWS), **(props or {})}
    needed = REQUIRED if require_credentials else ("url",)
    missing = [k for k in needed if not opts.get(k)]
    if missing:
        raise ValueError(f"missing connection settings: {', '.join(missing)}")
    ranged = (partition_column, lower, upper, num_partitions)
    if any(v is not None for v in ranged):
        if any(v is None for v in ranged):
            raise ValueError("partition_column, lower, upper and num_partitions go together")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(num_partitions),
        )
    return spark.read.format("jdbc").options(**opts).load()


def jdbc_bounds(spark: SparkSession, url: str, table: str, column: str, props: dict | None = None):
    """``(min, max)`` of ``column`` computed by the database (one row back).

    ``column`` and ``table`` are used as written in the SQL text; quote them
    in the database's syntax if they need quoting.
    """
    q = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
    row = spark.read.format("jdbc").options(url=url, query=q, **(props or {})).load().first()
    return row[0], row[1]


def load_jdbc_partitioned(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    num_partitions: int,
    props: dict | None = None,
    require_credentials: bool = True,
) -> DataFrame:
    """Read ``table`` in ``num_partitions`` parallel ranges of ``column``,
    with the range bounds taken from the database itself.  An empty table
    is read as a single task."""
    lo, hi = jdbc_bounds(spark, url, table, column, props)
    if lo is None:
        return load_jdbc(spark, url, table, props, require_credentials=require_credentials)
    return load_jdbc(
        spark, url, table, props, partition_column=column, lower=lo, upper=hi,
        num_partitions=num_partitions, require_credentials=require_credentials,
    )


# Columns the large tables are split on for parallel reads, and into how many.
SPLIT_COLUMNS = {"orders": "id", "order_product": "order_id"}
SPLIT = 16
# Rows fetched at a time; without it some drivers hold a whole result.
FETCH_ROWS = 10_000


def load_jdbc_tables(
    spark: SparkSession,
    url: str,
    props: dict | None = None,
    names=None,
    require_credentials: bool = True,
    **ranges,
) -> dict[str, DataFrame]:
    """All report tables from one database, conformed to the declared schemas.

    The large tables (orders, order lines) are read in ``split`` ranges of
    their id columns (``SPLIT`` by default; 0 reads each in one task), bounds
    taken from the database.  ``ranges`` maps a table name to its own
    ``dict(partition_column=..., lower=..., upper=..., num_partitions=...)``.
    """
    split = ranges.pop("split", SPLIT)
    out = {}
    for name in names or S.SCHEMAS:
        if split and name in SPLIT_COLUMNS and name not in ranges:
            df = load_jdbc_partitioned(spark, url, name, SPLIT_COLUMNS[name], split, props, require_credentials)
        else:
            df = load_jdbc(spark, url, name, props, require_credentials=require_credentials, **ranges.get(name, {}))
        out[name] = S.conform(df, S.SCHEMAS[name])
    return out


# --- the database as a catalog ----------------------------------------------


def jdbc_catalog(spark: SparkSession, name: str, url: str, props: dict | None = None) -> str:
    """Register a database as the catalog ``name``; filters and aggregates on its tables run in the database."""
    prefix = f"spark.sql.catalog.{name}"
    spark.conf.set(prefix, "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog")
    for key, value in {"url": url, "pushDownAggregate": "true", "fetchsize": str(FETCH_ROWS), **(props or {})}.items():
        spark.conf.set(f"{prefix}.{key}", str(value))
    return name


def load_catalog_tables(spark: SparkSession, catalog: str, namespace: str, names=None) -> dict[str, DataFrame]:
    """Report tables of a registered database, by their names in any case, conformed to the declared schemas."""
    found = {r["tableName"].lower(): r["tableName"] for r in spark.sql(f"SHOW TABLES IN `{catalog}`.`{namespace}`").collect()}
    wanted = list(names or S.SCHEMAS)
    missing = [n for n in wanted if n not in found]
    if missing:
        raise ValueError(f"the database has no table {', '.join(missing)}")
    return {n: S.conform(spark.table(f"`{catalog}`.`{namespace}`.`{found[n]}`"), S.SCHEMAS[n]) for n in wanted}


# --- ranges of about equal rows -------------------------------------------------

# Buckets the database counts for each range wanted, and how often one that is too full is counted again, finer (enough for any 64-bit ids).
BUCKETS_PER_RANGE = 16
REFINEMENTS = 12


def _counts(spark: SparkSession, url: str, query: str, props: dict | None) -> list[tuple]:
    rows = spark.read.format("jdbc").options(url=url, query=query, **(props or {})).load().collect()  # a row per bucket
    return [tuple(r) for r in rows]


def _cut(buckets: list[tuple], n: int) -> list:
    """First values of ``n`` ranges or fewer, from (first value, rows) in order."""
    total, filled, starts = sum(c for _, c in buckets), 0, []
    for first, rows in buckets:
        if not starts or filled >= len(starts) * total / n:
            starts.append(first)
        filled += rows
    return starts


def _number_buckets(spark, url, table, column, n, props) -> list[tuple[int, int]]:
    lo, hi = jdbc_bounds(spark, url, table, column, props)
    if lo is None:
        return []

    def count(low: int, high: int, parts: int) -> list[tuple[int, int, int]]:
        width = max(1, -(-(high - low + 1) // parts))
        bucket = f"FLOOR(({column} - {low}) / {width})"
        numbered = f"SELECT {bucket} AS b FROM {table} WHERE {column} BETWEEN {low} AND {high}"
        found = _counts(spark, url, f"SELECT b, COUNT(*) AS n FROM ({numbered}) buckets GROUP BY b", props)
        return sorted((low + int(b) * width, width, int(c)) for b, c in found)

    buckets = count(int(lo), int(hi), n * BUCKETS_PER_RANGE)
    share = sum(c for *_, c in buckets) / n
    for _ in range(REFINEMENTS):
        full = [b for b in buckets if b[2] > share / 2 and b[1] > 1]
        if not full:
            break
        finer = [x for low, width, _ in full for x in count(low, low + width - 1, BUCKETS_PER_RANGE * 4)]
        buckets = sorted([b for b in buckets if b not in full] + finer)
    return [(low, c) for low, _, c in buckets]


def equal_ranges(spark: SparkSession, url: str, table: str, column: str, n: int, props: dict | None = None) -> list[str]:
    """Predicates that cut ``table`` into at most ``n`` ranges of ``column`` with about equal rows, and one for its NULLs.

    For whole-number ids and for dates.  The database counts rows per bucket
    (per day for dates), so ids that crowd together, or busy days, get ranges
    of their own; one value is never cut.  Every row is in exactly one range.
    """
    kind = spark.read.format("jdbc").options(
        url=url, query=f"SELECT {column} FROM {table} WHERE 1 = 0", **(props or {})).load().schema[0].dataType.simpleString()
    if kind == "date":
        days = _counts(spark, url, f"SELECT {column} AS d, COUNT(*) AS n FROM {table} WHERE {column} IS NOT NULL GROUP BY {column}", props)
        starts = _cut(sorted((d, int(c)) for d, c in days), n)
        shown = [f"'{d.isoformat()}'" for d in starts]
    else:
        shown = [str(x) for x in _cut(_number_buckets(spark, url, table, column, n, props), n)]
    out = []
    for k, first in enumerate(shown):
        low = f"{column} >= {first}" if k else f"{column} IS NOT NULL"
        out.append(low if k + 1 == len(shown) else f"{low} AND {column} < {shown[k + 1]}")
    return out + [f"{column} IS NULL"]


def load_jdbc_in_ranges(spark: SparkSession, url: str, table: str, column: str, n: int, props: dict | None = None) -> DataFrame:
    """``table`` read in parallel, one task for each of ``equal_ranges``."""
    predicates = equal_ranges(spark, url, table, column, n, props)
    given = {"fetchsize": str(FETCH_ROWS), **(props or {})}
    return spark.read.jdbc(url, table, predicates=predicates, properties={k: str(v) for k, v in given.items()})


def load_jdbc_days(spark: SparkSession, url: str, table: str, column: str, start: dt.date, end: dt.date, n: int,
                   props: dict | None = None) -> DataFrame:
    """The rows of ``table`` from ``start`` to ``end``, read in ranges of days with about equal rows."""
    inside = f"(SELECT * FROM {table} WHERE {column} BETWEEN '{start.isoformat()}' AND '{end.isoformat()}') days"
    return load_jdbc_in_ranges(spark, url, inside, column, n, props)

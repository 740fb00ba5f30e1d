"""The report tables as named views of a schema, for SQL text.

``register`` makes one view per report table in a schema of the session
catalog.  A view casts its source to the declared column types
(``schema.SCHEMAS``) and carries the table's unique key as a property, so SQL
addresses the same typed tables whatever they come from: a Parquet folder
(plain or staged by date), a database, a bucketed table, or SQL over other files.

``run_sql`` runs a text over such a schema, or over a table dict, with typed
parameters: ``:start``, ``:end`` and ``:cutoff`` are the report period's dates.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ordertally import schema as S
from ordertally.params import ReportParams
from ordertally.session import scratch_path

KEY_PROPERTY = "ordertally.unique_key"


@dataclass(frozen=True)
class Source:
    """Where a table's rows are: a relation that SQL can name, and the columns it has."""

    relation: str
    have: DataFrame


def _name(text: str) -> str:
    return "`" + text.replace("`", "``") + "`"


def _text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def parquet_source(spark: SparkSession, path: str) -> Source:
    """A Parquet folder or file; date partitions are columns of it."""
    return Source(f"parquet.{_name(path)}", spark.read.parquet(path))


def sql_source(spark: SparkSession, text: str) -> Source:
    """SQL over relations that the session catalog or a path names."""
    return Source(f"({text})", spark.sql(text))


def table_source(spark: SparkSession, name: str) -> Source:
    """A table of any catalog (a bucketed table, a database's table through ``jdbc_catalog``)."""
    return Source(name, spark.table(name))


def create_schema(spark: SparkSession, schema: str) -> None:
    """The schema, if it is not there; its folder lies in the shared checkpoint folder and stays empty."""
    place = _text(scratch_path(spark, f"schema-{schema}"))
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_name(schema)} LOCATION {place}")


def _typed(column: str, have, want) -> str:
    """SQL of a column in its declared type; a value the type cannot hold exactly fails the read, as ``conform`` does."""
    c = _name(column)
    if have == want:
        return c
    to = want.simpleString()
    if S.always_exact(have, want):
        return f"CAST({c} AS {to}) AS {c}"
    exact = f"TRY_CAST({c} AS {to}) IS NOT NULL"
    if have.simpleString() != "string":
        exact = f"TRY_CAST(TRY_CAST({c} AS {to}) AS {have.simpleString()}) = {c}"
    fails = _text(f"{column} does not fit {to}: ")
    return (
        f"CASE WHEN {c} IS NULL OR {exact} THEN TRY_CAST({c} AS {to}) "
        f"ELSE CAST(RAISE_ERROR(CONCAT({fails}, CAST({c} AS STRING))) AS {to}) END AS {c}"
    )


def register(spark: SparkSession, schema: str, sources: dict[str, Source]) -> None:
    """Views of the named report tables in ``schema``, replacing those of the same names."""
    create_schema(spark, schema)
    for name, source in sources.items():
        fields = source.have.schema.fields
        have = {f.name.lower(): f.dataType for f in fields}
        want = S.resolved(S.SCHEMAS[name], source.have.schema)
        missing = [f.name for f in want.fields if f.name not in have]
        if missing:
            raise ValueError(f"table {name} lacks {', '.join(missing)}")
        columns = [_typed(f.name, have[f.name], f.dataType) for f in want.fields]
        # Staged lines carry their order's day; reports prune by it.
        columns += [_name(c) for c in have if c not in want.names and c == "delivery_date"]
        key = S.UNIQUE_KEYS.get(name)
        keys = f"TBLPROPERTIES ({_text(KEY_PROPERTY)} = {_text(key)}) " if key else ""
        spark.sql(
            f"CREATE OR REPLACE VIEW {_name(schema)}.{_name(name)} {keys}AS SELECT {', '.join(columns)} FROM {source.relation}"
        )


def register_parquet(spark: SparkSession, schema: str, root: str, names=None) -> None:
    """Views over a folder of tables, plain or as ``write_tables`` stages them."""
    from ordertally.sources.parquet import table_path

    register(spark, schema, {n: parquet_source(spark, table_path(root, n)) for n in (names or S.SCHEMAS)})


def register_tables(spark: SparkSession, schema: str, prefix: str, names=None) -> None:
    """Views over tables that another catalog or schema has under ``prefix`` (``shopdb.public``, a bucketed schema)."""
    register(spark, schema, {n: table_source(spark, f"{prefix}.{_name(n)}") for n in (names or S.SCHEMAS)})


def tables_of(spark: SparkSession, schema: str, names=None) -> dict[str, DataFrame]:
    """The registered report tables, as the reports take them."""
    known = {r["tableName"] for r in spark.sql(f"SHOW TABLES IN {_name(schema)}").collect()}  # a row per view
    return {n: spark.table(f"{_name(schema)}.{_name(n)}") for n in (names or S.SCHEMAS) if n in known}


def unique_key(spark: SparkSession, schema: str, name: str) -> str | None:
    """The declared unique key of a registered table."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {_name(schema)}.{_name(name)}").collect()
    return {r["key"]: r["value"] for r in rows}.get(KEY_PROPERTY)


def run_sql(spark: SparkSession, text: str, p: ReportParams | None = None, schema: str | None = None,
            tables: dict[str, DataFrame] | None = None, **args) -> DataFrame:
    """A SQL text as a source of rows.

    With ``schema`` plain table names in the text are its views.  With
    ``tables`` the text names them in braces (``FROM {orders}``).  Dates of the
    period and further ``args`` are bound as typed values (``:start``), never
    written into the text.
    """
    bound = dict(args)
    if p is not None:
        bound = {"start": p.start, "end": p.end, "cutoff": p.cutoff, **bound}
    bound = {k: v for k, v in bound.items() if f":{k}" in text}
    frames = {n: tables[n] for n in S.SCHEMAS if "{" + n + "}" in text} if tables is not None else {}
    if schema is None:
        return spark.sql(text, args=bound, **frames)
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(schema)
    try:
        return spark.sql(text, args=bound, **frames)  # names are resolved here
    finally:
        spark.catalog.setCurrentDatabase(before)

"""Sources: Parquet catalog, JDBC, and the test fixtures."""

from ordertally.sources.fixtures import fixture_tables
from ordertally.sources.jdbc import load_jdbc, load_jdbc_tables
from ordertally.sources.parquet import load_table, load_tables, write_tables

__all__ = ["fixture_tables", "load_jdbc", "load_jdbc_tables", "load_table", "load_tables", "write_tables"]

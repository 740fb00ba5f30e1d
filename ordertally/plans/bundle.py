"""Running a set of reports together.

The weekly reports all read the same slice of data: orders of the period
that are not cancelled, and their lines.  ``shared_inputs`` computes that
slice once (persisted, or written to the shared checkpoint folder) and the
reports read it instead of scanning the full tables twelve times.  Since
every report applies the period and status filters itself, results are
unchanged.

``run_all`` executes each report with its own write, isolates failures
(one failing report does not stop the others) and returns a manifest of
row counts, times and errors.  The catalog says which tables' keys a report
relies on; a table that cannot be read, lacks its key or repeats it fails those
reports only.  A report that fails leaves its former result in place.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ordertally.functions.dates import date_spine
from ordertally.operators.joins import counting_drops, dropped_rows, lines_of, measured_once
from ordertally.params import ReportParams
from ordertally.plans.catalog import BOUNDED_RESULTS, COLLATED, RELIES_ON, WEEKLY_REPORTS
from ordertally.plans.reports import LABELS, daily_product_totals, daily_status, period_lines, period_orders
from ordertally.schema import UNIQUE_KEYS, key_problems
from ordertally.session import delete_folder, path_exists, scratch_path
from ordertally.sinks.writers import read_report, report_path, with_empty_dates, with_labels, write_by_date, write_report

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("report", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("n_rows", T.LongType(), True),
        T.StructField("seconds", T.DoubleType(), True),
        T.StructField("error", T.StringType(), True),
        T.StructField("dropped", T.MapType(T.StringType(), T.LongType()), True),
    ]
)


class Overlay(dict):
    """A table dict with some tables replaced; other lookups fall through."""

    def __init__(self, base: dict[str, DataFrame], **replaced: DataFrame):
        super().__init__(replaced)
        self._base = base

    def __missing__(self, name: str) -> DataFrame:
        return self._base[name]


@dataclass
class SharedInputs:
    """Period orders and their lines, computed once for a bundle."""

    tables: dict[str, DataFrame]
    _cached: list = field(default_factory=list)
    _folder: str | None = None

    def release(self) -> None:
        for df in self._cached:
            df.unpersist()
        self._cached.clear()
        if self._folder is not None:
            delete_folder(self.tables["orders"].sparkSession, self._folder)
            self._folder = None


def shared_inputs(t: dict[str, DataFrame], p: ReportParams, mode: str = "persist") -> SharedInputs:
    """Tables restricted to the period's non-cancelled orders and their lines.

    ``mode="persist"`` caches them as they were scanned (memory, spilling to
    disk; a lost executor's blocks are recomputed from the source), so a hot
    order stays spread over the scan's partitions.  ``mode="table"`` writes
    them as Parquet under the shared ``spark.checkpoint.dir`` and reads them
    back, cutting the lineage.  ``mode=None`` shares nothing.
    """
    if mode is None:
        return SharedInputs(Overlay(t))
    orders = period_orders(t, p)
    lines = lines_of(orders, period_lines(t, p))
    shared = Overlay(t)
    out = SharedInputs(shared)
    if mode == "table":
        spark = orders.sparkSession
        root = scratch_path(spark, f"bundle-{uuid.uuid4().hex}")
        orders.write.parquet(f"{root}/orders")
        lines.write.parquet(f"{root}/order_product")
        shared["orders"] = spark.read.schema(orders.schema).parquet(f"{root}/orders")
        shared["order_product"] = spark.read.schema(lines.schema).parquet(f"{root}/order_product")
        out._folder = root
    elif mode == "persist":
        orders = orders.persist(StorageLevel.MEMORY_AND_DISK)
        lines = lines.persist(StorageLevel.MEMORY_AND_DISK)
        shared["orders"], shared["order_product"] = orders, lines
        out._cached.extend([orders, lines])
    else:
        raise ValueError(f"unknown sharing mode {mode!r}")
    return out


def build_reports(t: dict[str, DataFrame], p: ReportParams, names=None, periods=None) -> dict[str, DataFrame]:
    """Lazy report DataFrames by name (``periods`` overrides per report)."""
    periods = periods or {}
    return {n: WEEKLY_REPORTS[n](t, periods.get(n, p)) for n in (names or WEEKLY_REPORTS)}


class KeyChecks:
    """Key problems of the tables of a run, each table (and period of orders) checked once, when first asked for."""

    def __init__(self, t: dict[str, DataFrame], names):
        self.t = t
        wanted = {x for n in names for x in RELIES_ON.get(n, ())} - {"orders"}
        self.dimensions = [n for n in UNIQUE_KEYS if n in wanted]
        self.found: dict[str, str] | None = None
        self.orders: dict[tuple, str | None] = {}

    def problem(self, report: str, tables: dict[str, DataFrame], period: ReportParams) -> str | None:
        """What is wrong with a key that ``report`` relies on."""
        relies = RELIES_ON.get(report, ())
        if self.found is None and any(n != "orders" for n in relies):
            self.found = key_problems(self.t, self.dimensions)
        for name in relies:
            if name != "orders":
                if name in self.found:
                    return self.found[name]
                continue
            key = (period.start, period.end)
            if key not in self.orders:
                # Only the period's orders: the whole table's ids are never exchanged.
                try:
                    some = {"orders": period_orders(tables, period).select("id")}
                    self.orders[key] = key_problems(some, ["orders"]).get("orders")
                except Exception as e:
                    self.orders[key] = f"{type(e).__name__}: {e}"
            if self.orders[key] is not None:
                return self.orders[key]
        return None


def run_all(
    spark: SparkSession,
    t: dict[str, DataFrame],
    p: ReportParams,
    out: str | None = None,
    fmt: str = "parquet",
    names=None,
    share: str | None = "persist",
    periods=None,
    validate: bool = True,
    headers: bool = False,
    count_drops: bool = False,
    collation: str | None = None,
) -> DataFrame:
    """Run the weekly reports; write each to ``out/<name>_<start>_to_<end>``.

    Without ``out`` every report still runs completely (``noop`` sink), which
    is what benchmarks measure.  A failing report is recorded and the rest
    continue; with ``out`` it leaves a one-row ``error`` table, in its folder
    if that holds no former result, else beside it as ``<folder>_error``.  If
    the shared slice cannot be made, that is recorded as ``shared_inputs`` and
    the reports read the plain tables.  ``validate`` checks that the ids a
    report relies on are unique (``catalog.RELIES_ON``; of orders, those of
    its period) before it runs; otherwise that report fails.  ``headers``
    writes the display names of the columns.  ``count_drops`` counts the rows
    that inner joins to dimensions drop, per report and dimension (one more
    job per report).  ``collation``
    (e.g. ``"UTF8_LCASE"``) compares text as a case-insensitive database does,
    in the reports that group or join by text.  Returns the manifest
    DataFrame ``(report, status, n_rows, seconds, error, dropped)``.
    """
    periods = periods or {}
    names = list(names or WEEKLY_REPORTS)
    rows = []
    with measured_once():
        t0 = time.perf_counter()
        try:
            inputs = shared_inputs(t, p, share)
        except Exception as e:  # a table may be missing: only its reports fail
            inputs = SharedInputs(Overlay(t))
            rows.append(("shared_inputs", "failed", None, time.perf_counter() - t0, f"{type(e).__name__}: {e}", None))
        checks = KeyChecks(t, names if validate else ())
        try:
            for name in names:
                t0 = time.perf_counter()
                period = periods.get(name, p)
                # the shared slice holds the main period only; other periods read the tables
                tables = inputs.tables if period == p else t
                path = None if out is None else report_path(out, name, period.label)
                message = checks.problem(name, tables, period) if validate else None
                n, dropped = None, None
                if message is None:
                    try:
                        n, dropped = _run_one(name, tables, period, path, fmt, headers, count_drops, collation)
                    except Exception as e:  # isolate: record and continue
                        message = f"{type(e).__name__}: {e}"
                rows.append((name, "ok" if message is None else "failed", n, time.perf_counter() - t0, message, dropped))
                if path is not None:
                    _note_error(spark, path, fmt, message)
        finally:
            inputs.release()
    return spark.createDataFrame(rows, MANIFEST_SCHEMA)


def _run_one(name, tables, period, path, fmt, headers, count_drops, collation) -> tuple[int, dict[str, int] | None]:
    """Build and write one report; its row count, and its dropped rows if they are counted."""

    options = {"collation": collation} if collation and name in COLLATED else {}

    def run() -> int:
        df = WEEKLY_REPORTS[name](tables, period, **options)
        if headers:
            df = with_labels(df, LABELS.get(name, {}))
        if path is None:
            return write_report(df, "unused", fmt="noop")
        return write_report(df, path, fmt, single_file=name in BOUNDED_RESULTS)

    if not count_drops:
        return run(), None
    with counting_drops() as drops:
        n = run()
        return n, dropped_rows(drops)


def _note_error(spark: SparkSession, path: str, fmt: str, message: str | None) -> None:
    """Write a failed report's error table; a good run removes the one beside its result."""
    beside = f"{path}_error"
    if message is None:
        if path_exists(spark, beside):
            delete_folder(spark, beside)
        return
    error = spark.createDataFrame([(message,)], "error string")
    write_report(error, beside if path_exists(spark, path) else path, fmt, single_file=True)


def run_daily(
    spark: SparkSession,
    t: dict[str, DataFrame],
    start,
    end,
    out: str | None = None,
    fmt: str = "parquet",
    strict_status: bool = False,
    headers: bool = False,
) -> DataFrame:
    """Daily product totals for every day of a range in one pass.

    Writes the rows partitioned by ``report_date`` and returns the per-day
    status ``(report_date, n_rows, status)`` with ``'No Data'`` days.
    """
    totals = daily_product_totals(t, start, end, strict_status)
    if out is None:
        return daily_status(t, start, end, strict_status)
    label = f"{start}_to_{end}"
    totals = totals.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # The date column names the partition folders and keeps its name.
        names = {k: v for k, v in LABELS["daily_product_totals"].items() if k != "report_date"} if headers else {}
        write_by_date(with_labels(totals, names), report_path(out, "daily_product_totals", label), fmt=fmt)
        status_path = report_path(out, "daily_status", label)
        status = with_empty_dates(totals, date_spine(spark, start, end))
        write_report(status, status_path, fmt, single_file=True)
    finally:
        totals.unpersist()
    return read_report(spark, status_path, status.schema, fmt)

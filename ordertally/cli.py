"""Command line: the three report runs, with parameters as options.

    python -m ordertally weekly --tables DIR --out DIR [--start D --end D --cutoff D | --today D]
    python -m ordertally daily  --tables DIR --out DIR --range 111125-131125 [--strict-status]
    python -m ordertally detail --tables DIR --out DIR [--day D | --today D]
    python -m ordertally report NAME --tables DIR --out DIR --start D [--end D --cutoff D]
    python -m ordertally sql    --tables DIR --out DIR --file QUERY.sql [--start D --end D --cutoff D]
    python -m ordertally stage  --jdbc-url URL ... --out DIR [--jdbc-split N]

Tables come from a Parquet folder (``--tables``), a database
(``--jdbc-url`` with ``--jdbc-user``/``--jdbc-password``/``--jdbc-driver``,
``--jdbc-split N`` for parallel reads of the large tables) or the generated
test data (``--fixtures SF_DIR``).  ``stage`` copies the tables into the
date-partitioned Parquet layout that later runs read with ``--tables``.
``report`` runs one report by its name, ``sql`` a query text over the tables by
their names, with ``:start``, ``:end`` and ``:cutoff`` as dates.
Without ``--start`` the weekly run covers the last 7 days (8 calendar days
up to today); the detail run defaults to yesterday.  Exit status 1 if any report failed,
2 for unusable parameters.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ordertally.functions.dates import parse_range
from ordertally.params import ReportParams, last_n_days, yesterday
from ordertally.plans import bundle
from ordertally.plans.catalog import run_report
from ordertally.plans.reports import LABELS, daily_detail
from ordertally.schema import SCHEMAS
from ordertally.session import apply_recommended, ensure_checkpoint_dir
from ordertally.sinks.writers import report_path, with_labels, write_report
from ordertally.sources.catalog import run_sql


def _tables(spark: SparkSession, a: argparse.Namespace):
    if a.fixtures:
        from ordertally.sources.fixtures import fixture_tables

        return fixture_tables(spark, a.fixtures)
    if a.jdbc_url or a.db_env:
        import os

        from ordertally.sources.jdbc import SETTING_NAMES, load_jdbc_tables, settings_to_jdbc

        if a.db_env:
            url, props = settings_to_jdbc({k: os.environ.get(k) for k in SETTING_NAMES})
        else:
            url, props = a.jdbc_url, {"user": a.jdbc_user, "password": a.jdbc_password}
        props = {k: v for k, v in {**props, "driver": a.jdbc_driver}.items() if v}
        split = {} if a.jdbc_split is None else {"split": a.jdbc_split}
        return load_jdbc_tables(spark, url, props, require_credentials=bool(props.get("user")), **split)
    if a.tables:
        from ordertally.sources.parquet import load_tables

        return load_tables(spark, a.tables)
    raise SystemExit("give --tables, --jdbc-url, --db-env or --fixtures")


def parse_range_text(spark: SparkSession, text: str) -> tuple[dt.date, dt.date]:
    """Parse ``ddMMyy[-ddMMyy]`` (dots or slashes allowed) with the report's day parser."""
    start, end = parse_range(F.lit(text))
    row = spark.range(1).select(start.alias("s"), end.alias("e")).first()
    if row["s"] is None or row["e"] is None:
        raise ValueError(f"could not recognise the dates in {text!r}; use DDMMYY")
    if row["e"] < row["s"]:
        raise ValueError(f"range ends before it starts: {text!r}")
    return row["s"], row["e"]


def parse_periods(items) -> dict[str, ReportParams]:
    """``REPORT=START:END[:CUTOFF]`` options to per-report periods."""
    from ordertally.plans.catalog import WEEKLY_REPORTS

    out = {}
    for item in items:
        name, _, spec = item.partition("=")
        parts = spec.split(":")
        if name not in WEEKLY_REPORTS or len(parts) not in (2, 3):
            raise ValueError(f"bad --period-for {item!r}; use REPORT=START:END[:CUTOFF] with a weekly report name")
        out[name] = ReportParams(*parts)
    return out


def _period(a: argparse.Namespace) -> ReportParams:
    if a.start:
        return ReportParams(a.start, a.end or a.start, a.cutoff or None)
    if a.end or a.cutoff:
        raise ValueError("--end and --cutoff need --start")
    return last_n_days(a.today)


def _shown(dropped) -> str:
    return " dropped: " + ", ".join(f"{k} {v}" for k, v in sorted(dropped.items())) if dropped else ""


def _one(spark: SparkSession, t, a: argparse.Namespace) -> int:
    """One report by its name, or one query text."""
    p = _period(a)
    if a.command == "report":
        options = {"collation": a.collation} if a.collation else {}
        df, name = run_report(a.name, t, p, **options), a.name
        if a.headers:
            df = with_labels(df, LABELS.get(name, {}))
    else:
        for table in SCHEMAS:
            t[table].createOrReplaceTempView(table)
        df, name = run_sql(spark, Path(a.file).read_text(), p), Path(a.file).stem
    n = write_report(df, report_path(a.out, name, p.label), a.format)
    print(f"{name} {p.label}: {n} rows")
    return 0


def build_parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="ordertally", description=__doc__.split("\n\n")[0])
    sub = ap.add_subparsers(dest="command", required=True)
    for name in ("weekly", "daily", "detail", "report", "sql", "stage"):
        sp = sub.add_parser(name)
        if name == "report":
            sp.add_argument("name")
        sp.add_argument("--tables")
        sp.add_argument("--fixtures")
        sp.add_argument("--jdbc-url")
        sp.add_argument("--jdbc-user")
        sp.add_argument("--jdbc-password")
        sp.add_argument("--jdbc-driver")
        sp.add_argument("--jdbc-split", type=int, help="read orders and order lines in N parallel id ranges (default 16, 0: one task)")
        sp.add_argument("--db-env", action="store_true",
                        help="connect with DB_DRIVER, DB_USERNAME, DB_PASSWORD, DB_HOST, DB_PORT, DB_NAME")
        sp.add_argument("--out", required=True)
        sp.add_argument("--format", default="parquet", choices=["parquet", "csv", "json", "orc"])
        sp.add_argument("--today")
        if name != "stage":
            sp.add_argument("--headers", action="store_true", help="write the display names of the columns")
        if name in ("weekly", "report", "sql"):
            sp.add_argument("--start")
            sp.add_argument("--end")
            sp.add_argument("--cutoff")
        if name in ("weekly", "report"):
            sp.add_argument("--collation", help="compare text with this collation, e.g. UTF8_LCASE")
        if name == "sql":
            sp.add_argument("--file", required=True, help="the query text")
        if name == "weekly":
            sp.add_argument("--count-drops", action="store_true", help="count rows that joins to dimensions drop")
            sp.add_argument("--share", default="persist", choices=["persist", "table", "none"])
            sp.add_argument("--period-for", action="append", default=[], metavar="REPORT=START:END[:CUTOFF]",
                            help="give one report its own period, e.g. yearly_orders=2025-01-01:2025-12-31")
        elif name == "daily":
            sp.add_argument("--range", required=True, dest="range_text")
            sp.add_argument("--strict-status", action="store_true")
        elif name == "detail":
            sp.add_argument("--day")
    return ap


def main(argv=None, spark: SparkSession | None = None) -> int:
    a = build_parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("ordertally").getOrCreate()
    apply_recommended(spark)
    ensure_checkpoint_dir(spark)
    try:
        t = _tables(spark, a)
        if a.command == "weekly":
            p = _period(a)
            share = None if a.share == "none" else a.share
            periods = parse_periods(a.period_for)
            manifest = bundle.run_all(
                spark, t, p, out=a.out, fmt=a.format, share=share, periods=periods, headers=a.headers,
                collation=a.collation, count_drops=a.count_drops,
            )
            rows = manifest.collect()  # one row per report
            for r in rows:
                print(f"{r['report']:22s} {r['status']:7s} {r['n_rows'] if r['n_rows'] is not None else '-':>8} "
                      f"{r['seconds']:.1f}s {r['error'] or ''}{_shown(r['dropped'])}")
            return 1 if any(r["status"] != "ok" for r in rows) else 0
        if a.command in ("report", "sql"):
            return _one(spark, t, a)
        if a.command == "stage":
            from ordertally.sources.parquet import write_tables

            write_tables(t, a.out, names=list(SCHEMAS))
            print(f"staged {len(SCHEMAS)} tables under {a.out} (orders and lines by delivery date)")
            return 0
        if a.command == "daily":
            start, end = parse_range_text(spark, a.range_text)
            status = bundle.run_daily(spark, t, start, end, out=a.out, fmt=a.format, strict_status=a.strict_status, headers=a.headers)
            empty = status.filter(F.col("status") == "No Data").count()
            print(f"daily product totals {start}..{end} written; days without data: {empty}")
            return 0
        day = dt.date.fromisoformat(a.day) if a.day else yesterday(a.today)
        path = report_path(a.out, "daily_detail", day.isoformat())
        try:
            names = LABELS.get("daily_detail", {}) if a.headers else {}
            n = write_report(with_labels(daily_detail(t, day), names), path, a.format)
        except Exception as e:  # leaves an error table, as the weekly reports do
            message = f"{type(e).__name__}: {e}"
            write_report(spark.createDataFrame([(message,)], "error string"), path, a.format, single_file=True)
            print(f"daily detail {day} failed: {message}", file=sys.stderr)
            return 1
        print(f"daily detail {day}: {n} rows")
        return 0
    except ValueError as e:
        print(f"error: {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())

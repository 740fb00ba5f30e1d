"""Writing report results.

A bundle writes one dataset per report; a per-date report is written once,
partitioned by ``report_date`` (one directory per day that has rows).  Row
counts come from an ``Observation`` on the write itself, so counting costs
no second job.

A result is published in two steps.  It is written aside first, so a write that
fails halfway leaves the former result as it was.  Then the former result is
moved away and the new one into its place; a small note names the former
result until that is done, so a run that dies in between loses nothing either:
``current_path`` (and ``read_report``) follow the note, and the next write puts
the former result back before it begins.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ordertally.session import delete_folder, path_exists, read_note, rename_path, write_note


def _writer(df: DataFrame, fmt: str, mode: str):
    w = df.write.mode(mode).format(fmt)
    return w.option("header", "true") if fmt == "csv" else w


def _beside(path: str, mark: str) -> str:
    """A path in the same folder that Spark's readers pass over."""
    folder, name = os.path.split(path.rstrip("/"))
    return os.path.join(folder, f"_{mark}-{name}")


def current_path(spark: SparkSession, path: str) -> str:
    """Where the last complete result of ``path`` lies."""
    if not path_exists(spark, path):
        former = read_note(spark, _beside(path, "former"))
        if former and path_exists(spark, former):
            return former
    return path


def _publish(spark: SparkSession, aside: str, path: str) -> None:
    note = _beside(path, "former")
    former = _beside(path, f"former-{uuid.uuid4().hex}")
    replaces = path_exists(spark, path)
    if replaces:
        write_note(spark, note, former)
        rename_path(spark, path, former)
    rename_path(spark, aside, path)
    if replaces:
        delete_folder(spark, note)
        delete_folder(spark, former)


def _save(df: DataFrame, path: str, fmt: str, mode: str, partition_by: str | None = None) -> None:
    spark = df.sparkSession

    def save(target: str, how: str) -> None:
        w = _writer(df, fmt, how)
        (w.partitionBy(partition_by) if partition_by else w).save(target)

    if fmt == "noop" or mode != "overwrite":
        return save(path, mode)
    kept = current_path(spark, path)
    if kept != path:  # an earlier run died between the two renames
        rename_path(spark, kept, path)
    aside = _beside(path, f"new-{uuid.uuid4().hex}")
    try:
        save(aside, "errorifexists")
    except BaseException:
        delete_folder(spark, aside)
        raise
    _publish(spark, aside, path)


def write_report(df: DataFrame, path: str, fmt: str = "parquet", single_file: bool = False, mode: str = "overwrite") -> int:
    """Write one report and return its row count (observed during the write,
    in its result stage, so task retries do not count rows twice).

    ``single_file=True`` keeps the report's order in one file; use it only
    for aggregated results of bounded size.  Otherwise the range-partitioned
    output of a sorted report is written as is (files in order).
    """
    obs = Observation()
    out = df.observe(obs, F.count(F.lit(1)).alias("n_rows"))
    if single_file:
        out = out.coalesce(1)
    _save(out, path, fmt, mode)
    return int(obs.get["n_rows"])


def write_by_date(df: DataFrame, path: str, date_col: str = "report_date", fmt: str = "parquet", mode: str = "overwrite") -> int:
    """Write a dated report partitioned by ``date_col``; returns the row count."""
    obs = Observation()
    # REBALANCE (not repartition): rows of one date go to few files, and AQE
    # splits a date that holds a large share of the rows across tasks.  The
    # count is observed above the exchange, in the write's result stage,
    # where Spark applies each task's metrics once even after retries.
    out = df.hint("rebalance", date_col).observe(obs, F.count(F.lit(1)).alias("n_rows"))
    _save(out, path, fmt, mode, partition_by=date_col)
    return int(obs.get["n_rows"])


def read_report(spark, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """The last complete result of a written report, with its types."""
    reader = spark.read.schema(schema).format(fmt)
    return (reader.option("header", "true") if fmt == "csv" else reader).load(current_path(spark, path))


def with_empty_dates(df: DataFrame, spine: DataFrame, date_col: str = "report_date") -> DataFrame:
    """Per day of ``spine``: the number of result rows and ``'OK'`` or ``'No Data'``.

    ``spine`` has one row per day (bounded by the range length), so it is
    joined against the per-day counts, never against the rows themselves.
    """
    counts = df.groupBy(date_col).agg(F.count(F.lit(1)).alias("n"))
    # Both sides hold at most one row per day; AQE picks the join at run time.
    return spine.join(counts, date_col, "left").select(
        date_col,
        F.coalesce(F.col("n"), F.lit(0)).alias("n_rows"),
        F.when(F.col("n").isNull(), F.lit("No Data")).otherwise(F.lit("OK")).alias("status"),
    )


def report_path(root: str, name: str, label: str | None = None) -> str:
    """``<root>/<name>`` or ``<root>/<name>_<label>`` (label e.g. ``<start>_to_<end>``)."""
    return os.path.join(root, f"{name}_{label}" if label else name)


def with_labels(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Rename columns to display headers (only those present in ``df``)."""
    return df.withColumnsRenamed({k: v for k, v in labels.items() if k in df.columns})


def write_bundle(results: dict[str, DataFrame], root: str, fmt: str = "parquet", label: str | None = None,
                 single_file=(), display_labels: dict[str, dict[str, str]] | None = None) -> dict[str, int]:
    """Write each result to ``root/<name>[_<label>]``; returns row counts by name.

    Reports named in ``single_file`` are written as one ordered file (use for
    bounded, aggregated results only).  ``display_labels`` renames columns
    to display headers on the way out.
    """
    counts = {}
    for name, df in results.items():
        if display_labels and name in display_labels:
            df = with_labels(df, display_labels[name])
        counts[name] = write_report(df, report_path(root, name, label), fmt, single_file=name in single_file)
    return counts

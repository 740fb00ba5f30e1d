"""Incremental daily product totals over a staged table folder.

The source program is run once per day for the day's report.  Here the
same report (``plans.reports.daily_product_totals``) is kept up to date as
files land: a Structured Streaming query watches the staged ``orders`` and
``order_product`` folders (see ``sources.parquet.write_tables``), and each
micro-batch recomputes the report days that its new orders or lines can
affect (a window-0 order on day D+1 belongs to report day D) from the full
tables, replacing those ``report_date`` partitions of the output; a day left
without rows loses its partition.  Orders and lines may land in any order.
Recomputing whole days makes every batch idempotent, so a replay after a
failure gives the same output; progress is tracked in the checkpoint folder.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertally.plans.reports import daily_product_totals
from ordertally.session import delete_folder, scratch_path
from ordertally.sources.parquet import load_tables

_DATE = T.StructField("delivery_date", T.DateType(), True)


def touched_days(batch: DataFrame) -> list[tuple[dt.date, dt.date]]:
    """Ranges of consecutive report days that a batch's delivery dates can affect.

    One row per distinct day comes to the driver.
    """
    days = batch.select(F.explode(F.array(F.col("delivery_date"), F.date_sub("delivery_date", 1))).alias("day"))
    found = sorted(r.day for r in days.filter("day IS NOT NULL").distinct().collect())
    ranges: list[tuple[dt.date, dt.date]] = []
    for day in found:
        if ranges and day == ranges[-1][1] + dt.timedelta(days=1):
            ranges[-1] = (ranges[-1][0], day)
        else:
            ranges.append((day, day))
    return ranges


def refresh_days(spark: SparkSession, root: str, out: str, lo, hi, strict_status: bool = False) -> None:
    """Recompute report days ``lo..hi`` from the tables under ``root`` and
    replace those date partitions of ``out``; days without rows are removed."""
    t = load_tables(spark, root)
    totals = daily_product_totals(t, lo, hi, strict_status).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        filled = {r.report_date for r in totals.select("report_date").distinct().collect()}
        (
            totals.hint("rebalance", "report_date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("report_date")
            .parquet(out)
        )
    finally:
        totals.unpersist()
    for k in range((hi - lo).days + 1):
        day = lo + dt.timedelta(days=k)
        if day not in filled:
            delete_folder(spark, os.path.join(out, f"report_date={day.isoformat()}"))


def start_daily_totals(
    spark: SparkSession,
    root: str,
    out: str,
    checkpoint: str | None = None,
    strict_status: bool = False,
    available_now: bool = True,
):
    """Start the incremental daily-totals query; returns the StreamingQuery.

    ``available_now=True`` processes every order file that has arrived and
    stops (a scheduled daily run); ``False`` keeps watching.  Without
    ``checkpoint`` progress is kept in the session's shared folder.
    """
    checkpoint = checkpoint or scratch_path(spark, "daily-totals-stream")
    found = load_tables(spark, root, ["orders", "order_product"])
    if "delivery_date" not in found["order_product"].columns:
        raise ValueError("order lines must be staged by delivery date (write_tables)")

    def dates(name: str) -> DataFrame:
        path = os.path.join(root, name)
        schema = T.StructType([f for f in found[name].schema.fields if f.name != "delivery_date"] + [_DATE])
        return spark.readStream.schema(schema).option("basePath", path).parquet(path).select("delivery_date")

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        for lo, hi in touched_days(batch):
            refresh_days(batch.sparkSession, root, out, lo, hi, strict_status)

    landed = dates("orders").unionByName(dates("order_product"))
    writer = landed.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()

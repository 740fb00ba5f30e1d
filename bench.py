"""Benchmark: every report at one scale factor, printed as one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each report runs to completion into Spark's ``noop`` sink (all rows computed,
nothing collected), size checks included.  A warm-up pass runs first so JVM
start-up and code generation are not charged to the first report; its own
times, on a table set made for each report, are given as ``cold``.

Queries timed:
  r1..r14           each report alone, over the full tables
  bundle_shared     the 12 weekly reports with the period slice shared (persisted once)
  bundle_unshared   the same 12 reports, each scanning the full tables
  daily_30_one_pass daily product totals for 30 days as one grouped query
  daily_30_per_day  the same 30 days as 30 separate one-day queries (source program's loop),
                    without size checks
The headline value is the sum of r1..r14, each the best of three runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ordertally.params import ReportParams  # noqa: E402
from ordertally.operators import joins as J  # noqa: E402
from ordertally.plans import bundle as Bn  # noqa: E402
from ordertally.plans import reports as R  # noqa: E402
from ordertally.session import local_session  # noqa: E402
from ordertally.sinks.writers import write_report  # noqa: E402
from ordertally.sources import fixtures as FX  # noqa: E402

PERIOD = ReportParams(FX.PERIOD_START, FX.PERIOD_END, FX.PERIOD_CUTOFF)
YEAR = ReportParams("1996-01-01", "1996-12-31", "1996-12-01")
DAILY_START, DAILY_END = "1998-02-15", "1998-03-16"  # 30 days

REPORTS = {
    "r1_new_customers": lambda t: R.new_customers(t, PERIOD),
    "r2_packing_orders": lambda t: R.packing_orders(t, PERIOD),
    "r3_packing_by_worker": lambda t: R.packing_by_worker(t, PERIOD),
    "r4_missing_lines": lambda t: R.missing_lines(t, PERIOD),
    "r5_product_totals": lambda t: R.product_totals(t, PERIOD),
    "r6_customer_orders": lambda t: R.customer_orders(t, PERIOD),
    "r7_second_month_orders": lambda t: R.customer_orders(t, ReportParams("1996-02-01", "1996-02-29")),
    "r8_yearly_orders": lambda t: R.customer_orders(t, YEAR),
    "r9_recent_customers": lambda t: R.recent_customers(t, PERIOD),
    "r10_coupon_orders": lambda t: R.coupon_orders(t, PERIOD),
    "r11_zone_store_totals": lambda t: R.zone_store_totals(t, PERIOD),
    "r12_zone_totals": lambda t: R.zone_totals(t, PERIOD),
    "r13_daily_detail": lambda t: R.daily_detail(t, FX.DETAIL_DAY),
    "r14_daily_product_totals": lambda t: R.daily_product_totals(t, FX.RANGE_START, FX.RANGE_END),
}


def run(df) -> int:
    return write_report(df, "unused", fmt="noop")


def timed(fn, repeat: int = 1) -> float:
    """Best wall-clock seconds of ``repeat`` runs."""
    best = float("inf")
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn()
        best = min(best, time.perf_counter() - t0)
    return round(best, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores=cpus, shuffle_partitions=max(cpus, 8), app="ordertally-bench")
    t = FX.fixture_tables(spark, sf_dir)

    cold = {name: timed(lambda b=build: run(b(FX.fixture_tables(spark, sf_dir)))) for name, build in REPORTS.items()}

    times = {name: timed(lambda b=build: run(b(t)), repeat=3) for name, build in REPORTS.items()}
    headline = round(sum(times.values()), 3)

    Bn.run_all(spark, t, PERIOD, share="persist").count()  # warm-up of the cached-slice code path
    times["bundle_shared"] = timed(lambda: Bn.run_all(spark, t, PERIOD, share="persist").count())
    times["bundle_unshared"] = timed(lambda: Bn.run_all(spark, t, PERIOD, share=None).count())
    times["daily_30_one_pass"] = timed(lambda: run(R.daily_product_totals(t, DAILY_START, DAILY_END)))

    def per_day():
        from ordertally.params import day_list

        measured = J.fits_broadcast
        J.fits_broadcast = lambda df, max_bytes=None: True
        try:
            for d in day_list(DAILY_START, DAILY_END):
                run(R.daily_product_totals(t, d))
        finally:
            J.fits_broadcast = measured

    times["daily_30_per_day"] = timed(per_day)

    # Warm tables: the eight tables cached in memory across 8 partitions, as a
    # database server holds its tables in its buffer pool.  Reported apart
    # from the headline, which reads Parquet every time.
    from pyspark import StorageLevel

    warm = {k: t[k].repartition(max(cpus, 8)).persist(StorageLevel.MEMORY_AND_DISK) for k in FX.FIXTURE_SQL}
    for df in warm.values():
        df.count()
    for build in REPORTS.values():
        run(build(warm))
    warm_total = 0.0
    for name, build in REPORTS.items():
        warm_total += timed(lambda b=build: run(b(warm)), repeat=3)
    times["warm_tables_suite_total"] = round(warm_total, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "report_suite_total",
        "value": headline,
        "unit": "sec",
        "queries": times,
        "cold": cold,
        "cold_total": round(sum(cold.values()), 3),
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed to completion into Spark's ``noop`` sink (no driver
collect) twice: the first run pays one-off JVM/codegen compilation, the second
is timed (steady state). The two deployed jobs (landing -> minute table ->
marts) run on a fresh set of tables, once to warm up and once timed.
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sensorlake.plans import registry  # noqa: E402
from sensorlake.session import build_session  # noqa: E402

HEADLINE = [
    "raw_line_parse",        # landing lines -> typed rows + reject accounting
    "minute_rollup",         # AG1/AG2
    "interpolate_pooled",    # WN4/WN5 distributed row-position fill
    "dds_end_to_end",        # PL1: landing -> cleaned minute rows
    "dm_end_to_end",         # PL2: minutes -> hourly ML mart
    "ml_features",           # PL3
    "hourly_average",        # AG3
    "time_series_report",    # RP1
    "keep_first_dedupe",     # WN1
    "minute_stream",         # SS2 (Structured Streaming, availableNow)
]


def bench_jobs(spark, sf_dir: str, times: dict) -> None:
    """PL1 and PL2 as deployed: landing files -> minute table -> marts."""
    from sensorlake.operators.clean import row_index
    from sensorlake.plans.jobs import run_hour, run_minute
    from sensorlake.sources.landing import write_landing
    from sensorlake.sources.tables import Lakehouse
    from sensorlake.streaming.streams import scratch_path

    landing = scratch_path(spark, "bench-landing")
    lines = registry.lines(spark, sf_dir)
    write_landing(row_index(lines, ["timestamp", "event_id"]), landing)   # staging, not timed
    for attempt in range(2):
        lake = Lakehouse(spark, "bench_" + uuid.uuid4().hex[:8])
        lake.create_all()
        t0 = time.perf_counter()
        run_minute(spark, lake, landing)
        t1 = time.perf_counter()
        run_hour(spark, lake)
        t2 = time.perf_counter()
        if attempt:
            times["job_landing_to_minute"] = round(t1 - t0, 3)
            times["job_minute_to_hour"] = round(t2 - t1, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", int(cpus), extra={
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="sensorlake-bench-wh-"),
        "spark.driver.memory": "8g"})
    qs = registry.queries()
    times = {}
    for name in names:
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()   # warm-up
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    if not sys.argv[1:]:
        bench_jobs(spark, sf_dir, times)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()

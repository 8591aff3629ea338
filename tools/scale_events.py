"""Write a k-fold multiple of the driver's ``events`` table for scale runs.

usage: python tools/scale_events.py SRC_SF_DIR OUT_DIR K

Copy c of every event keeps its device, values and time of day but is shifted
by c times the table's time span, and gets event id ``event_id + c * N``, so
the result reads as a k-times longer history of the same devices.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from sensorlake.session import build_session  # noqa: E402


def main() -> None:
    src, out, k = sys.argv[1], sys.argv[2], int(sys.argv[3])
    spark = build_session("local[8]", 8)
    ev = spark.read.parquet(f"{src}/events.parquet")
    r = ev.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"), F.max("event_id").alias("n")).first()
    span_us = int((r["hi"] - r["lo"]).total_seconds() * 1e6) + 1_000_000
    n = r["n"] + 1
    copies = ev.select("*", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_c"))
    shifted = copies.select(
        (F.col("event_id") + F.col("_c") * F.lit(n)).alias("event_id"),
        F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.col("_c") * F.lit(span_us))
        .cast("timestamp_ntz").alias("ts"),
        "user_id", "event_type", "value", "props")
    shifted.repartition(max(8, k // 4)).write.mode("overwrite").parquet(f"{out}/events.parquet")
    print(spark.read.parquet(f"{out}/events.parquet").count())


if __name__ == "__main__":
    main()

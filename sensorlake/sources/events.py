"""Telemetry derived from the driver's ``events`` table.

The reference ships one landing file and one mart export; for scale tests the
same data shape is derived, with Spark, from ``events``: three devices, five
features at storage precision, a 0/1 light flag, and raw landing lines with a
known share of faulty lines. The mapping rules are fixed values shared with the
DuckDB oracle SQL in ``sensorlake.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.functions.columns import timestamp_text

# --- fixed values of the derivation ----------------------------------------
DEVICE_PREFIX = "b8:27:eb:bf:9d:5"   # + (user_id % 3)
DEVICE_COUNT = 3
FAULTY_LINE_EVERY = 97               # event_id % 97 == 0 -> "<ts> <device>" + 7 blanks
BAD_NUMBER_EVERY = 89                # event_id % 89 == 0 -> co token "x"
LIGHT_ON_EVENT = "view"
# ----------------------------------------------------------------------------


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's ``events`` table. It is one parquet file with a single row
    group, i.e. one scan task; it is spread over the cluster's cores so that
    line encoding and parsing do not run in a single task (landing zones of
    many files are already read in parallel)."""
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    cores = spark.sparkContext.defaultParallelism
    if len(df.inputFiles()) < cores:
        df = df.repartition(cores)
    return df


def _d(x: Column, p: int, s: int) -> Column:
    return x.cast(f"decimal({p},{s})")


def telemetry_from_events(events: DataFrame) -> DataFrame:
    """One sensor reading per event, typed like the minute table."""
    value2 = _d(F.col("value"), 12, 2)
    return events.select(
        F.col("ts").cast("timestamp_ntz").alias("timestamp"),
        F.concat(F.lit(DEVICE_PREFIX), (F.col("user_id") % DEVICE_COUNT).cast("string")).alias("device_id"),
        _d(value2 / 10000, 12, 10).alias("co"),
        _d(F.lit(30) + _d((F.col("event_id") * 7) % 400, 5, 1) / 10, 5, 1).alias("humidity"),
        _d(F.lit(0.005).cast("decimal(4,3)") + value2 / 20000, 12, 10).alias("lpg"),
        _d(_d(F.col("user_id") + 1, 12, 2) / 10000, 12, 10).alias("smoke"),
        _d(F.lit(15) + _d(F.col("event_id") % 150, 5, 1) / 10, 5, 1).alias("temperature"),
        F.when(F.col("event_type") == LIGHT_ON_EVENT, 1).otherwise(0).alias("light"),
        F.col("event_id"),
    )


def raw_lines_from_telemetry(tel: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """PJ2: encode telemetry rows as raw landing lines, with the fault model
    (faulty lines and a non-numeric token) keyed on ``event_id``. ``keep``
    columns are passed through."""
    ts_txt = timestamp_text(F.col("timestamp"))
    co_tok = F.when(F.col("event_id") % BAD_NUMBER_EVERY == 0, F.lit("x")).otherwise(
        F.col("co").cast("string"))
    good = F.concat_ws(" ", ts_txt, F.col("device_id"), co_tok,
                       *[F.col(c).cast("string") for c in ("humidity", "lpg", "smoke", "temperature", "light")])
    faulty = F.concat(ts_txt, F.lit(" "), F.col("device_id"), F.lit(" " * 7))
    line = F.when(F.col("event_id") % FAULTY_LINE_EVERY == 0, faulty).otherwise(good)
    return tel.select(F.col("event_id"), *(keep or []), line.alias("value"))

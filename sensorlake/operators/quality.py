"""Data-quality checks and reports (Q1-Q6, RP2, SS4 late rows)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.schemas import DEVICE_ID_MAX_LEN, EXPECTED_MINUTES_PER_HOUR, KEYS, LIGHT_DOMAIN


def constraint_violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Q1-Q4: violations per (column, check) of the declared storage schema,
    counted in one aggregate pass; rows with zero violations are omitted."""
    counts = []
    for f in schema.fields:
        c = F.col(f.name)
        if not f.nullable:
            counts.append((f.name, "not_null", c.isNull()))
        if f.name == "light" and isinstance(f.dataType, T.ShortType):
            counts.append((f.name, "domain", ~c.isin(*LIGHT_DOMAIN)))
        if f.name == "device_id":
            counts.append((f.name, "length", F.length(c) > DEVICE_ID_MAX_LEN))
        if isinstance(f.dataType, T.DecimalType):
            counts.append((f.name, "range", c.isNotNull() & c.try_cast(f.dataType).isNull()))
    aggs = [F.count_if(F.coalesce(cond, F.lit(False))).alias(f"{col}__{chk}") for col, chk, cond in counts]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{col}', '{chk}', `{col}__{chk}`" for col, chk, _ in counts)
    long = wide.selectExpr(f"stack({len(counts)}, {pairs}) as (column_name, check_name, violations)")
    return long.where(F.col("violations") > 0)


def duplicate_keys(df: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Q6: keys stored more than once, with their copy count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def completeness(count_mart: DataFrame, expected: int = EXPECTED_MINUTES_PER_HOUR,
                 only_incomplete: bool = True) -> DataFrame:
    """RP2: minutes per (hour, device) against the expected 60."""
    out = count_mart.select(
        "timestamp", "device_id", "record_count",
        (F.lit(100.0) * F.col("record_count") / F.lit(float(expected))).alias("completeness_pct"))
    return out.where(F.col("record_count") != expected) if only_incomplete else out


def hour_calendar(hourly: DataFrame) -> DataFrame:
    """RP2: every hour of every device from its first hour to the newest hour of all devices.

    One row per device is unfolded to its hours; the newest hour is a one-row broadcast."""
    first = hourly.groupBy("device_id").agg(F.min("timestamp").alias("_first"))
    last = hourly.agg(F.max("timestamp").alias("_last"))
    hours = F.explode(F.sequence("_first", "_last", F.expr("INTERVAL 1 HOUR"))).alias("timestamp")
    return first.crossJoin(F.broadcast(last)).select("device_id", hours)


def calendar_completeness(count_mart: DataFrame, expected: int = EXPECTED_MINUTES_PER_HOUR,
                          only_incomplete: bool = True) -> DataFrame:
    """RP2 over the hour calendar: an hour in which a device sent nothing appears with 0 %."""
    keys = ["timestamp", "device_id"]
    counted = hour_calendar(count_mart).join(count_mart.select(*keys, "record_count"), keys, "left")
    return completeness(counted.withColumn("record_count", F.coalesce("record_count", F.lit(0))), expected, only_incomplete)


def late_rows(rows: DataFrame, watermark: _dt.datetime | None, ts_col: str = "timestamp") -> DataFrame:
    """SS4: rows at or behind the target's watermark, per device (they would
    be dropped by the next incremental load)."""
    if watermark is None:
        cond = F.lit(False)
    else:
        cond = F.col(ts_col) <= F.lit(watermark).cast("timestamp_ntz")
    return rows.where(cond).groupBy("device_id").agg(F.count(F.lit(1)).alias("late_rows"))

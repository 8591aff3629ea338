"""Dashboard queries over the marts (RP1, RP3, SC6, FL8, FL9, ST2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.operators.slices import devices, time_range
from sensorlake.schemas import FEATURES, KEYS


def time_series_report(average: DataFrame, extreme: DataFrame, device_ids=None,
                       start=None, end=None) -> DataFrame:
    """RP1: avg/min/max of every feature per (hour, device) in a time range.

    Filters are applied to both marts before the join, so they reach both
    scans (and their ``dt`` partitions)."""
    def cut(df: DataFrame) -> DataFrame:
        return time_range(devices(df, device_ids), start, end)

    avg = cut(average).select(*KEYS, *[F.col(f).alias(f"avg_{f}") for f in FEATURES])
    ext = cut(extreme).select(*KEYS, *[F.col(f"{m}_{f}") for f in FEATURES for m in ("min", "max")])
    return avg.join(ext, KEYS, "inner")


def time_series(stats: DataFrame, device_ids=None, start=None, end=None) -> DataFrame:
    """RP1 from one frame of hourly statistics, without a join of two marts."""
    hours = time_range(devices(stats, device_ids), start, end)
    return hours.select(*KEYS, *[F.col(f"mean_{f}").alias(f"avg_{f}") for f in FEATURES],
                        *[F.col(f"{m}_{f}") for f in FEATURES for m in ("min", "max")])


def device_summary(minutes: DataFrame, device_ids=None, start=None, end=None) -> DataFrame:
    """RP3: per-device mean, standard deviation and count of every feature."""
    df = time_range(devices(minutes, device_ids), start, end)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for f in FEATURES:
        x = F.col(f).cast("double")
        aggs += [F.avg(x).alias(f"avg_{f}"), F.stddev_samp(x).alias(f"std_{f}")]
    return df.groupBy("device_id").agg(*aggs)


def export_order(df: DataFrame) -> DataFrame:
    """ST2: the (timestamp, device_id) order of a mart export."""
    return df.orderBy(*KEYS)

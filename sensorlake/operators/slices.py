"""Time slices and watermarks (FL3-FL5, FL9, AG10, AG11, JN4, SF15, ST3)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_UNITS = {"minute", "hour", "day"}


def full_periods(df: DataFrame, unit: str, ts_col: str = "timestamp") -> DataFrame:
    """FL4/FL5: keep rows strictly before the start of the period that holds the
    latest timestamp, i.e. only complete periods.

    The cut is a one-row aggregate joined back as a broadcast scalar (JN4):
    nothing goes through the driver. An empty input gives an empty output.
    """
    if unit not in _UNITS:
        raise ValueError(f"unit must be one of {_UNITS}")
    cut = df.agg(F.date_trunc(unit, F.max(ts_col)).cast("timestamp_ntz").alias("_cut"))
    return (df.crossJoin(F.broadcast(cut))
            .where(F.col(ts_col) < F.col("_cut"))
            .drop("_cut"))


def after_watermark(df: DataFrame, watermark: _dt.datetime | None, ts_col: str = "timestamp",
                    inclusive: bool = False) -> DataFrame:
    """FL3/SF15: rows later than the target's watermark; everything when None.

    The watermark is a literal so the predicate reaches the parquet scan
    (row-group statistics) and the ``dt`` partition filter below prunes files.
    """
    if watermark is None:
        return df
    wm = F.lit(watermark).cast("timestamp_ntz")
    cond = F.col(ts_col) >= wm if inclusive else F.col(ts_col) > wm
    if "dt" in df.columns:
        cond = cond & (F.col("dt") >= F.lit(watermark.date()))
    return df.where(cond)


def time_range(df: DataFrame, start=None, end=None, ts_col: str = "timestamp") -> DataFrame:
    """FL9: half-open range [start, end) with a matching date-partition predicate."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(ts_col) >= F.lit(start).cast("timestamp_ntz"))
        if "dt" in df.columns:
            cond = cond & (F.col("dt") >= F.lit(start).cast("date"))
    if end is not None:
        cond = cond & (F.col(ts_col) < F.lit(end).cast("timestamp_ntz"))
        if "dt" in df.columns:
            cond = cond & (F.col("dt") <= F.lit(end).cast("date"))
    return df.where(cond)


def devices(df: DataFrame, device_ids: list[str] | None) -> DataFrame:
    """FL8: device filter (pushed to the scan)."""
    if not device_ids:
        return df
    return df.where(F.col("device_id").isin(list(device_ids)))


def latest_timestamp(table: DataFrame, ts_col: str = "timestamp") -> _dt.datetime | None:
    """AG11/ST3: ``MAX(timestamp)`` of a table, None when empty.

    Of a date-partitioned table the timestamps of the newest ``dt`` partition
    only are read, after an aggregate over the partition column; for a catalog
    table ``Lakehouse.latest_timestamp`` finds that partition without any scan.
    The result is one scalar.
    """
    if "dt" in table.columns:
        newest = table.agg(F.max("dt").alias("dt")).first()["dt"]
        if newest is None:
            return None
        table = table.where(F.col("dt") == F.lit(newest))
    return table.agg(F.max(ts_col).alias("wm")).first()["wm"]

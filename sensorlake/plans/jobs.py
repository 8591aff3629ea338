"""End-to-end jobs (PL1, PL2, PL4).

``minute_batch`` and ``hour_batch`` are pure DataFrame plans; ``run_minute``
and ``run_hour`` add the watermark, the idempotent append and the writes.
"""

from __future__ import annotations

import datetime as _dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.functions.columns import floor_hour
from sensorlake.operators.clean import clean_sequenced, sequence_batch
from sensorlake.operators.marts import all_marts, hourly_stats
from sensorlake.operators.parse import accepted, parse_lines, rejected
from sensorlake.operators.rollup import minute_rollup
from sensorlake.operators.slices import after_watermark, full_periods
from sensorlake.operators.store import (append_new, date_bounds, storage_cast, storage_rejects,
                                        stored_rows, with_partition_columns)
from sensorlake.schemas import FEATURES, FILE_LEDGER_NAME, MART_NAMES, MINUTE_TABLE, MINUTE_TABLE_NAME, mart_schema
from sensorlake.sources.landing import history_to_lines, list_landing, read_history_csv, read_landing, write_landing
from sensorlake.sources.ledger import LATE, REFUSED, ledger_rows
from sensorlake.sources.tables import Lakehouse
from sensorlake.session import ensure_checkpoint_dir

# Tie-break of the pooled time order: the reference sorts on time only
# (unstable); we add device, file and the raw line so results are repeatable.
ORDER_COLS = ["timestamp", "device_id", "file_name", "raw_line"]


def pinned(df: DataFrame) -> DataFrame:
    """Materialize ``df`` in the shared checkpoint folder and cut its lineage.

    Used where a result is read several times (bounds, anti-join, rejects):
    it is computed once, survives the loss of an executor, and later plans
    start from a plain scan instead of a deep expression tree (constraint
    inference over 35 derived mart columns grows very large otherwise)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def minute_batch(lines: DataFrame, watermark: _dt.datetime | None = None, clean: bool = True,
                 group_cols: list[str] | None = None, exact_quantiles: bool = True,
                 num_partitions: int | None = None) -> DataFrame:
    """PL1 plan: lines -> parsed -> complete minutes after the watermark ->
    (clip + interpolate) -> one row per (minute, device), features as DOUBLE."""
    if "file_name" not in lines.columns:
        lines = lines.withColumn("file_name", F.lit(""))
    rows = accepted(parse_lines(lines, keep=["file_name"]))
    if clean:
        # one pin: the parsed rows in time order, without the raw text; the cut,
        # the quantiles and the interpolation read it
        rows = sequence_batch(rows, ORDER_COLS, group_cols, num_partitions)
    # FL4: the cut uses the max over the whole batch, before the lower bound
    rows = after_watermark(full_periods(rows, "minute"), watermark)
    if clean:
        rows = clean_sequenced(rows, FEATURES, group_cols, exact_quantiles)
    return minute_rollup(rows, with_count=False)


def run_minute(spark: SparkSession, lake: Lakehouse, landing_path: str, clean: bool = True,
               group_cols: list[str] | None = None, exact_quantiles: bool = True,
               ingest_seq: int | None = None, ledger_days: int | None = None) -> dict:
    """PL1: landing files newer than the minute table's watermark -> minute table.

    First and later runs read by one rule: a file whose name carries no valid time is refused,
    one whose time is not later than the watermark is late; both go to the file ledger unread
    (``sources.ledger``), which is written before the minutes. ``ledger_days``: how many days
    before the watermark's ``day=`` folders are still searched for late files (None: all of them).

    Returns the watermark used, the reject DataFrames and this run's ledger rows: ``files``, and of
    them ``refused_files`` and ``late_files``."""
    lake.create(MINUTE_TABLE_NAME)
    lake.create(FILE_LEDGER_NAME)
    table = lake.read(MINUTE_TABLE_NAME)
    wm = lake.latest_timestamp(MINUTE_TABLE_NAME)
    seq = ingest_seq if ingest_seq is not None else int(time.time() * 1e6)
    lines = read_landing(spark, landing_path, since=wm).where(F.col("file_time").isNotNull())
    horizon = wm - _dt.timedelta(days=ledger_days) if wm is not None and ledger_days is not None else None
    lake.append(FILE_LEDGER_NAME, ledger_rows(list_landing(spark, landing_path, horizon), lake.read(FILE_LEDGER_NAME), lines, wm, seq, horizon))
    files = lake.read(FILE_LEDGER_NAME).where(F.col("ingest_seq") == seq)
    minutes = minute_batch(lines, wm, clean, group_cols, exact_quantiles)
    # pin the typed minute rows once: the date bounds, the anti-join and the
    # reject report all read them, and the cut lineage keeps the plans small
    cast = pinned(storage_cast(minutes, MINUTE_TABLE))
    ok = stored_rows(cast)
    bounds = date_bounds(ok)
    new = append_new(ok, table, bounds=bounds)
    lake.append(MINUTE_TABLE_NAME, with_partition_columns(new, seq))
    return {
        "watermark": wm,
        "line_rejects": rejected(parse_lines(lines)),
        "storage_rejects": storage_rejects(cast),
        "files": files,
        "refused_files": files.where(F.col("status") == REFUSED),
        "late_files": files.where(F.col("status") == LATE),
    }


def hour_batch(minutes: DataFrame) -> dict[str, DataFrame]:
    """PL2 plan: complete hours of the minute rows -> the four marts (DOUBLE)."""
    stats = hourly_stats(full_periods(minutes, "hour"))
    return all_marts(stats)


def _hour_input(lake: Lakehouse) -> tuple[_dt.datetime | None, DataFrame]:
    """The minutes of an hourly run and their lower bound (None: all minutes).

    Each mart has its own watermark (a failed run of one mart does not leave
    holes in the others); the scan starts at the oldest. The change of a
    device's first new hour needs its last stored hour again, however long
    ago that was: the last hours come from one aggregate over the ML mart, and
    of the minutes before the bound only those hours of the devices that have
    new minutes are read (their dates prune the partitions)."""
    minutes = lake.read(MINUTE_TABLE_NAME)
    marks = [lake.latest_timestamp(t) for t in MART_NAMES]
    if any(m is None for m in marks):
        return None, minutes
    start = min(marks)
    fresh = after_watermark(minutes, start, inclusive=True)
    last = (lake.read("dm_iot_ml").where(F.col("timestamp") < F.lit(start))
            .join(fresh.select("device_id").distinct(), "device_id", "left_semi")
            .groupBy("device_id").agg(F.max("timestamp").alias("hour")))
    last = pinned(last)
    dates = [r["d"] for r in last.select(F.to_date("hour").alias("d")).distinct().collect()]  # days of history at most
    earlier = (minutes.where(F.col("dt").isin(dates) & (F.col("timestamp") < F.lit(start)))
               .withColumn("hour", floor_hour(F.col("timestamp")))
               .join(last, ["device_id", "hour"], "left_semi").select(*minutes.columns))
    return start, fresh.unionByName(earlier)


def run_hour(spark: SparkSession, lake: Lakehouse, ingest_seq: int | None = None) -> dict:
    """PL2: minute table -> four hourly marts, each appended idempotently.

    The hourly statistics are computed once (one window + one aggregate),
    persisted (they are small: one row per hour and device) and projected
    into the four marts. When all four are written, one commit record
    publishes them together (``Lakehouse.read_published``)."""
    lake.create_all()
    start, minutes = _hour_input(lake)
    stats = hourly_stats(full_periods(minutes, "hour")).persist()
    seq = ingest_seq if ingest_seq is not None else int(time.time() * 1e6)
    if (published := lake.published_seq()) is not None and published > seq:
        raise ValueError(f"load {seq} is older than the published one, {published}")
    rejects = {}
    try:
        bounds = date_bounds(stats)
        for name, mart in all_marts(stats).items():
            cast = pinned(storage_cast(mart, mart_schema(name)))
            new = append_new(stored_rows(cast), lake.read(name), bounds=bounds)
            lake.append(name, with_partition_columns(new, seq))
            rejects[name] = storage_rejects(cast)
        lake.commit(seq)
    finally:
        stats.unpersist()
    return {"scan_start": start, "storage_rejects": rejects}


def load_history(spark: SparkSession, csv_path: str, landing_path: str,
                 num_partitions: int | None = None) -> None:
    """PL4: historical CSV -> raw lines -> landing files of 1,000 records
    in time order."""
    from sensorlake.operators.clean import row_index
    lines = history_to_lines(read_history_csv(spark, csv_path))
    indexed = row_index(lines, ["timestamp", "device_id", "value"], num_partitions=num_partitions)
    write_landing(indexed, landing_path)

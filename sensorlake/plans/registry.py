"""Registered queries: one per operator family of the inventory.

Every query reads the driver's tables (``events`` -> telemetry, raw lines)
from ``sf_dir`` and runs over all of their rows. DOUBLE outputs are rounded
to 12 decimals, as in the DuckDB oracles of ``sensorlake.plans.oracle``.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.functions.columns import file_name_timestamp, floor_minute, timestamp_text
from sensorlake.operators.clean import batch_quantiles, clean_batch, clip_outliers, row_index
from sensorlake.operators.marts import (average_mart, count_mart, extreme_mart, hourly_stats, ml_mart,
                                        with_changes)
from sensorlake.operators.parse import accepted, parse_lines, reject_counts
from sensorlake.operators.quality import calendar_completeness, completeness, constraint_violations, duplicate_keys, late_rows
from sensorlake.operators.report import device_summary, export_order, time_series
from sensorlake.operators.rollup import minute_rollup
from sensorlake.operators.slices import after_watermark, devices, full_periods, latest_timestamp
from sensorlake.operators.store import append_new, dedupe_first, storage_cast
from sensorlake.plans.jobs import hour_batch, minute_batch
from sensorlake.schemas import FEATURES, MINUTE_TABLE, RATIOS
from sensorlake.sources.events import raw_lines_from_telemetry, read_events, telemetry_from_events
from sensorlake.sources.landing import batch_labels, history_to_lines

ROUND = 12  # decimals kept on DOUBLE outputs, here and in the oracles
WINDOW_DAYS = 7  # report / watermark window, counted back from the newest reading


def need_utc(spark: SparkSession) -> None:
    """The lines and tables are in UTC; the caller's session has to be, too."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def rounded(df: DataFrame, digits: int = ROUND) -> DataFrame:
    """Round every DOUBLE column (same rounding in the oracle)."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


# --- inputs derived from the driver tables --------------------------------------
def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    need_utc(spark)
    return telemetry_from_events(read_events(spark, sf_dir))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw landing lines with the event time (arrival order)."""
    return raw_lines_from_telemetry(telemetry(spark, sf_dir), keep=["timestamp"])


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_lines(raw_lines_from_telemetry(telemetry(spark, sf_dir)))


def accepted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted(parsed(spark, sf_dir))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Historical-CSV-shaped rows (epoch seconds, boolean light)."""
    tel = telemetry(spark, sf_dir)
    return tel.select(
        "event_id",
        (F.unix_micros(F.col("timestamp").cast("timestamp")) / F.lit(1e6)).alias("ts"),
        F.col("device_id").alias("device"),
        *[F.col(f).cast("double").alias("temp" if f == "temperature" else f) for f in FEATURES],
        (F.col("light") == 1).alias("light"))


def window_start(df: DataFrame) -> _dt.datetime:
    return latest_timestamp(df) - _dt.timedelta(days=WINDOW_DAYS)


# --- queries ---------------------------------------------------------------------
def q_raw_line_encode(spark, sf_dir):
    return raw_lines_from_telemetry(telemetry(spark, sf_dir))


def q_raw_line_parse(spark, sf_dir):
    return accepted_rows(spark, sf_dir).drop("raw_line")


def q_reject_counts(spark, sf_dir):
    return reject_counts(parsed(spark, sf_dir))


def q_history_epoch_to_lines(spark, sf_dir):
    return history_to_lines(history(spark, sf_dir), keep=["event_id"])


def q_full_minute_slice(spark, sf_dir):
    return full_periods(accepted_rows(spark, sf_dir), "minute").select("event_id", "timestamp", "device_id")


def q_full_hour_slice(spark, sf_dir):
    return full_periods(telemetry(spark, sf_dir), "hour").select("event_id", "timestamp", "device_id")


def q_watermark_slice(spark, sf_dir):
    tel = telemetry(spark, sf_dir)
    return after_watermark(tel, window_start(tel)).select("event_id", "timestamp", "device_id")


def q_batch_quantiles(spark, sf_dir):
    return rounded(batch_quantiles(accepted_rows(spark, sf_dir), FEATURES))


def q_outlier_clip(spark, sf_dir):
    acc = accepted_rows(spark, sf_dir)
    return clip_outliers(acc, batch_quantiles(acc, FEATURES)).select("event_id", *FEATURES)


def q_interpolate_pooled(spark, sf_dir):
    out = clean_batch(accepted_rows(spark, sf_dir), ["timestamp", "device_id", "raw_line"], FEATURES,
                      keep_index="row_idx")
    return rounded(out.select("event_id", "row_idx", *FEATURES))


def q_interpolate_per_device(spark, sf_dir):
    out = clean_batch(accepted_rows(spark, sf_dir), ["timestamp", "raw_line"], FEATURES,
                      group_cols=["device_id"], keep_index="row_idx")
    return rounded(out.select("event_id", "device_id", "row_idx", *FEATURES))


def q_row_index(spark, sf_dir):
    return row_index(lines(spark, sf_dir), ["timestamp", "event_id"]).select("event_id", "row_idx")


def _labels(spark, sf_dir):
    return batch_labels(row_index(lines(spark, sf_dir), ["timestamp", "event_id"]), ["row_idx"])


def q_batch_labels(spark, sf_dir):
    return _labels(spark, sf_dir)


def q_file_name_timestamp(spark, sf_dir):
    names = _labels(spark, sf_dir).select("batch_no", F.concat(F.col("batch"), F.lit(".txt")).alias("file_name"))
    return names.select("batch_no", file_name_timestamp(F.col("file_name")).alias("file_time"))


def q_new_files(spark, sf_dir):
    since = window_start(telemetry(spark, sf_dir))
    files = q_file_name_timestamp(spark, sf_dir)
    return files.where(F.col("file_time") > F.lit(since).cast("timestamp_ntz"))


def q_minute_rollup(spark, sf_dir):
    return rounded(minute_rollup(accepted_rows(spark, sf_dir)))


def q_dds_end_to_end(spark, sf_dir):
    raw = raw_lines_from_telemetry(telemetry(spark, sf_dir))
    return rounded(minute_batch(raw, None, clean=True))


def q_dm_end_to_end(spark, sf_dir):
    return rounded(hour_batch(telemetry(spark, sf_dir))["dm_iot_ml"])


def _stats(spark, sf_dir):
    return hourly_stats(telemetry(spark, sf_dir))


def q_hourly_average(spark, sf_dir):
    return rounded(average_mart(_stats(spark, sf_dir)))


def q_hourly_extreme(spark, sf_dir):
    return rounded(extreme_mart(_stats(spark, sf_dir)))


def q_hourly_count(spark, sf_dir):
    return count_mart(_stats(spark, sf_dir))


def _stat_cols(spark, sf_dir, stat):
    return rounded(_stats(spark, sf_dir).select("timestamp", "device_id", *[f"{stat}_{f}" for f in FEATURES]))


def q_hourly_mean(spark, sf_dir):
    return _stat_cols(spark, sf_dir, "mean")


def q_hourly_median(spark, sf_dir):
    return _stat_cols(spark, sf_dir, "median")


def q_hourly_variance(spark, sf_dir):
    return _stat_cols(spark, sf_dir, "variance")


def q_hourly_change(spark, sf_dir):
    chg = with_changes(_stats(spark, sf_dir))
    return rounded(chg.select("timestamp", "device_id", *[f"{f}_change_last_hour" for f in FEATURES]))


def _ml(spark, sf_dir):
    return ml_mart(_stats(spark, sf_dir))


def q_hourly_ratios(spark, sf_dir):
    return rounded(ml_mart(_stats(spark, sf_dir), changes=False).select("timestamp", "device_id", *RATIOS))


def q_variance_to_mean(spark, sf_dir):
    return rounded(ml_mart(_stats(spark, sf_dir), changes=False).select(
        "timestamp", "device_id", *[f"variance_to_mean_{f}" for f in FEATURES]))


def q_high_low_percentage(spark, sf_dir):
    return rounded(ml_mart(_stats(spark, sf_dir), changes=False).select(
        "timestamp", "device_id", *[f"high_low_percentage_{f}" for f in FEATURES]))


def q_ml_features(spark, sf_dir):
    return rounded(_ml(spark, sf_dir))


def q_keep_first_dedupe(spark, sf_dir):
    tel = telemetry(spark, sf_dir).withColumn("timestamp", floor_minute(F.col("timestamp")))
    return dedupe_first(tel, ["timestamp", "device_id"], "event_id")


def q_anti_join_append(spark, sf_dir):
    tel = telemetry(spark, sf_dir)
    # the middle of the time span, as a one-row broadcast
    mid = tel.agg((F.min("timestamp") + (F.max("timestamp") - F.min("timestamp")) / 2).alias("_mid"))
    early = tel.crossJoin(F.broadcast(mid)).where(F.col("timestamp") < F.col("_mid")).drop("_mid")
    stored = minute_rollup(early)
    return rounded(append_new(minute_rollup(tel), stored))


def q_constraint_violations(spark, sf_dir):
    return constraint_violations(parsed(spark, sf_dir), MINUTE_TABLE)


def q_duplicate_keys(spark, sf_dir):
    tel = telemetry(spark, sf_dir).withColumn("timestamp", floor_minute(F.col("timestamp")))
    return duplicate_keys(tel)


def q_time_series_report(spark, sf_dir):
    tel = telemetry(spark, sf_dir)
    return rounded(time_series(hourly_stats(tel), start=window_start(tel)))


def q_completeness_monitor(spark, sf_dir):
    minutes = minute_rollup(accepted_rows(spark, sf_dir), with_count=False)
    return rounded(completeness(count_mart(hourly_stats(minutes))))


def q_device_summary(spark, sf_dir):
    return rounded(device_summary(telemetry(spark, sf_dir)))


def q_late_rows(spark, sf_dir):
    tel = telemetry(spark, sf_dir)
    return late_rows(tel, window_start(tel))


def q_union_files(spark, sf_dir):
    hist = history_to_lines(history(spark, sf_dir), keep=["event_id"]).select(
        F.lit("history").alias("source"), "event_id", "value")
    land = raw_lines_from_telemetry(telemetry(spark, sf_dir)).select(
        F.lit("landing").alias("source"), "event_id", "value")
    return hist.unionByName(land)


def q_storage_cast(spark, sf_dir):
    minutes = minute_rollup(accepted_rows(spark, sf_dir), with_count=False)
    return storage_cast(minutes, MINUTE_TABLE).drop("reject")


def q_minute_stream(spark, sf_dir):
    from sensorlake.streaming.streams import run_minute_stream_once
    return rounded(run_minute_stream_once(spark, raw_lines_from_telemetry(telemetry(spark, sf_dir))))


def q_hour_stream(spark, sf_dir):
    from sensorlake.streaming.streams import run_hour_stream_once
    return rounded(run_hour_stream_once(spark, raw_lines_from_telemetry(telemetry(spark, sf_dir))))


# --- the deployed jobs, on catalog tables of a database of their own ---------------------
def _thirds(spark, sf_dir, indexed=None):
    """The landing lines in three parts by time, each staged as landing files: (path, stage next part)."""
    from sensorlake.sources.landing import write_landing
    from sensorlake.streaming.streams import scratch_path

    if indexed is None:
        indexed = row_index(lines(spark, sf_dir), ["timestamp", "event_id"])
    span = indexed.agg(F.max("row_idx").alias("n")).first()["n"] or 0
    path = scratch_path(spark, "landing")

    def stage(part: int) -> str:
        here = F.floor((F.col("row_idx") - 1) * 3 / F.lit(max(span, 1))) == part
        write_landing(indexed.where(here), path)
        return path

    return stage


def _job_lake(spark):
    from sensorlake.sources.tables import Lakehouse

    lake = Lakehouse(spark, "sensorlake_" + uuid.uuid4().hex[:12])
    lake.create_all()
    return lake


def _minute_rows(lake):
    return lake.read("dds_iot_data").select(*[f.name for f in MINUTE_TABLE.fields])


def q_job_minutes(spark, sf_dir):
    """Landing files -> run_minute after each third -> the stored minutes."""
    from sensorlake.plans.jobs import run_minute

    lake, stage = _job_lake(spark), _thirds(spark, sf_dir)
    for part in range(3):
        run_minute(spark, lake, stage(part), clean=False, ingest_seq=part)
    return _done(lake, _minute_rows(lake))


def q_job_marts(spark, sf_dir):
    """The stored minutes in three parts -> run_hour after each -> the four marts side by side."""
    from sensorlake.operators.store import stored_rows, with_partition_columns
    from sensorlake.plans.jobs import pinned, run_hour

    lake = _job_lake(spark)
    minutes = pinned(stored_rows(storage_cast(
        minute_rollup(full_periods(accepted_rows(spark, sf_dir), "minute"), with_count=False), MINUTE_TABLE)))
    span = minutes.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).first()
    if span["lo"] is not None:
        third = (span["hi"] - span["lo"]) / 3
        for part in range(3):
            lo, hi = span["lo"] + part * third, span["lo"] + (part + 1) * third
            here = (F.col("timestamp") >= F.lit(lo).cast("timestamp_ntz")) if part else F.lit(True)
            if part < 2:
                here = here & (F.col("timestamp") < F.lit(hi).cast("timestamp_ntz"))
            lake.append("dds_iot_data", with_partition_columns(minutes.where(here), part))
            run_hour(spark, lake, ingest_seq=part)
    keys = ["timestamp", "device_id"]
    read = {t: lake.read(t).drop("ingest_seq", "dt") for t in ("dm_iot_average", "dm_iot_extreme", "dm_iot_count", "dm_iot_ml")}
    return _done(lake, read["dm_iot_average"].join(read["dm_iot_extreme"], keys).join(read["dm_iot_count"], keys)
                 .join(read["dm_iot_ml"], keys))


def q_minute_table_stream(spark, sf_dir):
    """The streaming sink over the thirds of the landing lines, one micro-batch each."""
    from sensorlake.streaming.streams import minute_table_sink, scratch_path

    lake, stage = _job_lake(spark), _thirds(spark, sf_dir)
    pending, checkpoint = scratch_path(spark, "pending"), scratch_path(spark, "sink-ckpt")
    for part in range(3):
        minute_table_sink(spark, lake, stage(part), pending, checkpoint, clean=False).awaitTermination()
    return _done(lake, _minute_rows(lake))


def q_history_load(spark, sf_dir):
    """Historical CSV with missing values -> landing files -> parsed rows."""
    from sensorlake.plans.jobs import load_history
    from sensorlake.sources.landing import read_landing
    from sensorlake.streaming.streams import scratch_path

    csv, landing = scratch_path(spark, "history"), scratch_path(spark, "landing")
    hist = history(spark, sf_dir)
    hist = hist.withColumn("co", F.when(F.col("event_id") % 61 != 0, F.col("co"))).drop("event_id")
    hist.write.option("header", True).csv(csv)
    load_history(spark, csv, landing)
    return parse_lines(read_landing(spark, landing), keep=[]).drop("raw_line")


def q_reject_reasons(spark, sf_dir):
    """Lines and minutes of every reject reason: faults by event id, at the parser and at storage."""
    faulty = _faulty_lines(telemetry(spark, sf_dir))
    rows = parse_lines(faulty, keep=["event_id"])
    at_parse = reject_counts(rows).select(F.lit("line").alias("stage"), "reason", "lines")
    minutes = storage_cast(minute_rollup(accepted(rows), with_count=False), MINUTE_TABLE)
    at_store = (minutes.groupBy(F.coalesce("reject", F.lit("ok")).alias("reason")).agg(F.count("*").alias("lines"))
                .select(F.lit("minute").alias("stage"), "reason", "lines"))
    return at_parse.unionByName(at_store)


def _faulty_lines(tel):
    """Raw lines with a fault for some event ids: month 99, light 2, an 18-character device, a zone offset, a
    type suffix, a co of 123 and a missing humidity."""
    at = lambda n: F.col("event_id") % n == 0
    text = timestamp_text(F.col("timestamp"))
    text = F.when(at(73), F.regexp_replace(text, "-[0-9]{2}-", "-99-")).when(at(71), F.concat(text, F.lit("+05:00"))).otherwise(text)
    device = F.when(at(79), F.concat("device_id", F.lit("0"))).otherwise(F.col("device_id"))
    co = F.when(at(67), F.lit("1.0d")).when(at(5), F.lit("123.0")).otherwise(F.col("co").cast("string"))
    humidity = F.when(at(7), F.lit("nan")).otherwise(F.col("humidity").cast("string"))
    light = F.when(at(83), F.lit("2")).otherwise(F.col("light").cast("string"))
    rest = [F.col(c).cast("string") for c in ("lpg", "smoke", "temperature")]
    return tel.select("event_id", F.concat_ws(" ", text, device, co, humidity, *rest, light).alias("value"))


def _done(lake, rows: DataFrame) -> DataFrame:
    """What a job has left, pinned, so that the job's database can go."""
    from sensorlake.plans.jobs import pinned

    out = pinned(rows)
    lake.drop_database()
    return out


def q_job_minutes_clean(spark, sf_dir):
    """``job_minutes`` with quantiles, clipping and interpolation in every load."""
    from sensorlake.plans.jobs import run_minute

    lake, stage = _job_lake(spark), _thirds(spark, sf_dir)
    for part in range(3):
        run_minute(spark, lake, stage(part), ingest_seq=part)
    return _done(lake, _minute_rows(lake))


def q_minute_table_stream_clean(spark, sf_dir):
    """``minute_table_stream`` with the full cleaning in every micro-batch."""
    from sensorlake.streaming.streams import minute_table_sink, scratch_path

    lake, stage = _job_lake(spark), _thirds(spark, sf_dir)
    pending, checkpoint = scratch_path(spark, "pending"), scratch_path(spark, "sink-ckpt")
    for part in range(3):
        minute_table_sink(spark, lake, stage(part), pending, checkpoint).awaitTermination()
    return _done(lake, _minute_rows(lake))


def q_file_ledger(spark, sf_dir):
    """Three loads; before the second a file without a valid name, before the third every 700th line again."""
    from sensorlake.plans.jobs import run_minute
    from sensorlake.sources.landing import write_landing

    again = row_index(lines(spark, sf_dir), ["timestamp", "event_id"])
    lake, stage = _job_lake(spark), _thirds(spark, sf_dir, again)
    for part in range(3):
        path = stage(part)
        if part == 1:
            again.where("row_idx <= 3").select("value").coalesce(1).write.mode("append").text(f"{path}/day=none/batch=unnamed")
        if part == 2:
            write_landing(again.where("event_id % 700 = 0"), path)
        run_minute(spark, lake, path, clean=False, ingest_seq=part)
    counts = [F.col(c).cast("double").alias(c) for c in ("lines", "rejected_lines", "late_lines")]  # null for files that are not read
    files = lake.read("landing_files").select(F.col("ingest_seq").alias("load"), "status", "file_time", "watermark", *counts)
    return _done(lake, files)


def q_hour_change_stream(spark, sf_dir):
    """Hour-over-hour changes of the hour stream, restarted after each third of the lines."""
    from sensorlake.streaming.streams import hour_change_sink, scratch_path

    stage, out, checkpoint = _thirds(spark, sf_dir), scratch_path(spark, "changes"), scratch_path(spark, "ckpt")
    for part in range(3):
        hour_change_sink(spark, stage(part), out, checkpoint).awaitTermination()
    return rounded(spark.read.parquet(out))


def q_stream_late_rows(spark, sf_dir):
    """Late rows per micro-batch and device: every 50th line arrives again with the last third."""
    from sensorlake.streaming.streams import late_row_counts, minute_table_sink, scratch_path

    lake, stage = _job_lake(spark), _thirds(spark, sf_dir)
    pending, checkpoint, late = (scratch_path(spark, k) for k in ("pending", "sink-ckpt", "late"))
    for part in range(3):
        path = stage(part)
        if part == 2:
            lines(spark, sf_dir).where("event_id % 50 = 0").select("value").write.mode("append").text(f"{path}/day=none/batch=again")
        minute_table_sink(spark, lake, path, pending, checkpoint, clean=False, late_path=late).awaitTermination()
    return _done(lake, late_row_counts(spark, late))


def q_landing_stream_batches(spark, sf_dir):
    """Lines that arrive in five parts -> landing files of 1,000 lines across the micro-batches."""
    from sensorlake.sources.landing import landing_files, read_landing
    from sensorlake.streaming.streams import close_landing_batches, landing_batch_sink, landing_stream, scratch_path

    indexed = row_index(lines(spark, sf_dir), ["timestamp", "event_id"])
    source, out, pending, checkpoint = (scratch_path(spark, k) for k in ("in", "landing", "open-batch", "ckpt"))
    n = max(indexed.count(), 1)
    for part in range(5):
        here = F.floor((F.col("row_idx") - 1) * 5 / F.lit(n)) == part
        indexed.where(here).select("value").write.mode("append").text(source)
        landing_batch_sink(landing_stream(spark, source), out, pending, checkpoint).awaitTermination()
    close_landing_batches(spark, out, pending)
    return landing_files(read_landing(spark, out)).select("file_time", "lines")


def q_mart_publication(spark, sf_dir):
    """Rows of each mart that readers see: after the first days, after a load that fails between two marts, and after the next one."""
    from sensorlake.operators.store import stored_rows, with_partition_columns
    from sensorlake.plans.jobs import pinned, run_hour
    from sensorlake.schemas import MART_NAMES
    from sensorlake.sources.tables import Lakehouse

    class Failing(Lakehouse):
        def append(self, table, rows):
            if table == "dm_iot_count":
                raise OSError("injected failure")
            super().append(table, rows)

    lake = _job_lake(spark)
    minutes = pinned(stored_rows(storage_cast(
        minute_rollup(full_periods(accepted_rows(spark, sf_dir), "minute"), with_count=False), MINUTE_TABLE)))
    first = minutes.agg(F.min("timestamp")).first()[0] or _dt.datetime.min
    cut = F.lit(_dt.datetime.combine(first.date(), _dt.time()) + _dt.timedelta(days=10)).cast("timestamp_ntz")
    steps = []

    def seen(step: str) -> None:
        steps.extend((step, t, lake.read_published(t).count()) for t in MART_NAMES)

    lake.append("dds_iot_data", with_partition_columns(minutes.where(F.col("timestamp") < cut), 0))
    run_hour(spark, lake, ingest_seq=1)
    seen("first days")
    lake.append("dds_iot_data", with_partition_columns(minutes.where(F.col("timestamp") >= cut), 1))
    try:
        run_hour(spark, Failing(spark, lake.database), ingest_seq=2)
    except OSError:
        seen("failed load")
    run_hour(spark, lake, ingest_seq=3)
    seen("next load")
    lake.drop_database()
    return spark.createDataFrame(steps, "step string, mart string, rows long")


def _stored_minutes(spark, sf_dir) -> DataFrame:
    """The minutes as the minute table stores them: at most 60 rows for an hour and device."""
    from sensorlake.operators.store import stored_rows

    rollup = minute_rollup(full_periods(accepted_rows(spark, sf_dir), "minute"), with_count=False)
    return stored_rows(storage_cast(rollup, MINUTE_TABLE))


def q_minute_fed_marts(spark, sf_dir):
    """The four marts of the complete hours, side by side, from stored minutes in one pass."""
    from sensorlake.plans.jobs import pinned

    marts = hour_batch(pinned(_stored_minutes(spark, sf_dir)))
    keys = ["timestamp", "device_id"]
    out = marts["dm_iot_average"]
    for name in ("dm_iot_extreme", "dm_iot_count", "dm_iot_ml"):
        out = out.join(marts[name], keys)
    return rounded(out)


def q_minute_fed_report(spark, sf_dir):
    """The time-series report of the last days, from stored minutes."""
    from sensorlake.plans.jobs import pinned

    minutes = pinned(_stored_minutes(spark, sf_dir))
    start = F.lit(latest_timestamp(minutes) - _dt.timedelta(days=WINDOW_DAYS)).cast("timestamp_ntz")
    return rounded(time_series(hourly_stats(minutes)).where(F.col("timestamp") >= start))


def q_completeness_calendar(spark, sf_dir):
    """Incomplete device-hours, those without any record included."""
    minutes = minute_rollup(accepted_rows(spark, sf_dir), with_count=False)
    return rounded(calendar_completeness(count_mart(hourly_stats(minutes))))


def q_table_lifecycle(spark, sf_dir):
    """Tables created, probed, filled, emptied of one, and dropped: rows that each step leaves in each table."""
    from sensorlake.operators.store import stored_rows, with_partition_columns
    from sensorlake.sources.tables import TABLES

    lake = _job_lake(spark)
    minutes = storage_cast(minute_rollup(accepted_rows(spark, sf_dir), with_count=False), MINUTE_TABLE)
    steps = []

    def seen(step: str) -> None:
        counts = [(lake.read(t).agg(F.count("*").alias("rows")) if lake.exists(t) else spark.range(1).select(F.lit(None).cast("long").alias("rows")))
                  .select(F.lit(step).alias("step"), F.lit(t).alias("table_name"), F.lit(lake.exists(t)).alias("present"), F.col("rows").cast("double")) for t in TABLES]
        for c in counts:
            steps.append(c.collect()[0])

    seen("created")
    lake.append("dds_iot_data", with_partition_columns(stored_rows(minutes), 1))
    lake.create_all()  # changes nothing
    seen("filled")
    lake.drop("dm_iot_ml")
    seen("one dropped")
    lake.drop_all()
    seen("all dropped")
    lake.drop_database()
    return spark.createDataFrame(steps, "step string, table_name string, present boolean, rows double")


def q_device_export(spark, sf_dir):
    """The time-series report of one device in export order."""
    stats = hourly_stats(devices(telemetry(spark, sf_dir), ["b8:27:eb:bf:9d:51"]))
    return rounded(export_order(time_series(stats)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name[2:]: fn for name, fn in globals().items() if name.startswith("q_") and callable(fn)}

"""Streaming (SS1-SS7).

* ``landing_stream``      SS1/SC7: file source over the landing zone.
* ``minute_stream``       SS2: tumbling 1-minute event-time windows with a
  zero-delay watermark, append mode - a minute is emitted once the newest
  event time has passed its end, which is the batch job's full-minute cut.
* ``hour_stream``         SS3: chained 1-hour windows over the minute windows.
* ``hour_change_stream``  WN2: hour-over-hour change, the device's last hour in keyed state.
* ``late_rows`` in ``sensorlake.operators.quality`` counts what the watermark drops (SS4).
* ``minute_table_sink``   SS5/SS6: ``foreachBatch`` running the full batch
  cleaning on each micro-batch, carrying the rows after the newest stored
  minute over in a pending folder and appending idempotently (anti-join on
  stored keys); the rows that the watermark drops are counted per device and
  micro-batch (SS4).
* ``landing_batch_sink``  SS7/SK2: landing files of exactly 1,000 lines with their
  label; an unfilled batch is carried from one micro-batch to the next.
* ``landing_sink``        SS7: streaming text sink, files of at most 1,000 lines.

Streams use TIMESTAMP event time (watermarks refuse TIMESTAMP_NTZ); tables
keep TIMESTAMP_NTZ. The session time zone is UTC, so the casts are exact.
"""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.operators.parse import accepted, parse_lines
from sensorlake.operators.rollup import light_mode
from sensorlake.operators.store import append_new, date_bounds, storage_cast, stored_rows, with_partition_columns
from sensorlake.schemas import FEATURE_DECIMAL, FEATURES, LANDING_FILE_RECORDS, MINUTE_TABLE, MINUTE_TABLE_NAME, RAW_LINE, dec
from sensorlake.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh folder inside the shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def landing_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """SS1/SC7: raw lines of files arriving in the landing folder."""
    reader = spark.readStream.schema(RAW_LINE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path).select("value", F.col("_metadata.file_name").alias("file_name"))


def _event_time(df: DataFrame) -> DataFrame:
    return df.withColumn("event_time", F.col("timestamp").cast("timestamp"))


def minute_stream(lines: DataFrame, allowed_lateness: str = "0 seconds") -> DataFrame:
    """SS2: complete (minute, device) windows of a line stream; ``window`` is
    kept for chaining (``hour_stream``)."""
    rows = _event_time(accepted(parse_lines(lines, keep=[])))
    agg = (rows.withWatermark("event_time", allowed_lateness)
           .groupBy(F.window("event_time", "1 minute"), "device_id")
           .agg(*[F.avg(f).alias(f) for f in FEATURES], light_mode().alias("light"),
                F.count(F.lit(1)).alias("raw_rows")))
    return agg.select(F.col("window.start").cast("timestamp_ntz").alias("timestamp"),
                      "device_id", *FEATURES, "light", "raw_rows", "window")


def hour_stream(minutes: DataFrame) -> DataFrame:
    """SS3: complete (hour, device) windows over a minute stream (AG3-AG5, AG12).

    A window's above-mean share needs its mean first, so the hour's values are
    kept per feature (at most 60 minutes of a device, at storage precision, so
    that the comparison is exact) and counted when it closes."""
    aggs = [F.count(F.lit(1)).alias("record_count"), F.avg(F.col("light").cast("double")).alias("light")]
    for f in FEATURES:
        aggs += [F.avg(f).alias(f), F.max(f).alias(f"max_{f}"), F.min(f).alias(f"min_{f}"), F.collect_list(F.col(f).cast(dec(FEATURE_DECIMAL[f]))).alias(f"_all_{f}")]
    hours = (minutes.groupBy(F.window(F.window_time("window"), "1 hour").alias("hwin"), "device_id")
             .agg(*aggs))
    for f in FEATURES:
        total = F.aggregate(f"_all_{f}", F.lit(0).cast("decimal(38,10)"), lambda a, x: (a + x).cast("decimal(38,10)"))
        n = F.size(f"_all_{f}")
        above = F.size(_above(F.col(f"_all_{f}"), total, n))
        hours = hours.withColumn(f"high_low_percentage_{f}", F.lit(100.0) * above / F.col("record_count"))
    return hours.select(F.col("hwin.start").cast("timestamp_ntz").alias("timestamp"),
                        "device_id", *[c for c in hours.columns if c not in ("hwin", "device_id") and not c.startswith("_all_")])


_CHANGES = [f"{f}_change_last_hour" for f in FEATURES]


def hour_change_stream(hours: DataFrame) -> DataFrame:
    """WN2 on the hour stream: each hour's means minus those of the device's previous observed hour.

    Keyed state: one row per device, the means of its last hour, so the change spans micro-batches,
    restarts and silent hours. Hours of a device leave ``hour_stream`` in the order of time, as an hour is
    emitted when the watermark has passed it; those of one micro-batch are sorted here. The state store has
    to be RocksDB (``rocksdb_state``)."""
    means = ", ".join(f"{f} double" for f in FEATURES)
    out = "timestamp timestamp_ntz, device_id string, " + ", ".join(f"{c} double" for c in _CHANGES)
    return (hours.select("timestamp", "device_id", *FEATURES).groupBy("device_id")
            .transformWithStateInPandas(_last_hour(list(FEATURES), list(_CHANGES), means), out, "Append", "none"))


def _last_hour(features: list[str], changes: list[str], schema: str):
    """The processor of ``hour_change_stream``; made here, so that executors need no module of ours."""
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    class LastHour(StatefulProcessor):
        def init(self, handle) -> None:
            self.last = handle.getValueState("last_hour", schema)

        def handleInputRows(self, key, rows, timerValues):
            import pandas as pd

            hours = pd.concat(list(rows)).sort_values("timestamp")
            before = list(self.last.get()) if self.last.exists() else [None] * len(features)
            means = pd.concat([pd.DataFrame([before], columns=features, dtype="float64"), hours[features].astype("float64")], ignore_index=True)
            self.last.update(tuple(None if pd.isna(x) else float(x) for x in means.iloc[-1]))
            moved = means.diff().iloc[1:].set_axis(changes, axis=1).reset_index(drop=True)
            yield pd.concat([hours[["timestamp", "device_id"]].reset_index(drop=True), moved], axis=1)

        def close(self) -> None:
            pass

    return LastHour()


@contextlib.contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries that start inside keep their state in RocksDB, as ``transformWithState`` demands."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _above(values, total, n):
    """The values above the mean, by the exact comparison of the batch marts."""
    return F.filter(values, lambda x: x * n > total)


def run_to_parquet(stream: DataFrame, spark: SparkSession, kind: str) -> DataFrame:
    """Run a stream over everything available (``availableNow``) into a
    parquet folder (append mode) and read the result back as a batch frame."""
    out, ckpt = scratch_path(spark, f"{kind}-out"), scratch_path(spark, f"{kind}-ckpt")
    q = (stream.writeStream.format("parquet").outputMode("append")
         .option("path", out).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


def stage_lines(spark: SparkSession, lines: DataFrame) -> str:
    """Write lines as landing text files in the shared scratch area."""
    path = scratch_path(spark, "landing")
    lines.select("value").write.text(path)
    return path


def run_minute_stream_once(spark: SparkSession, lines: DataFrame) -> DataFrame:
    src = landing_stream(spark, stage_lines(spark, lines))
    return run_to_parquet(minute_stream(src).drop("window"), spark, "minute-stream")


def run_hour_stream_once(spark: SparkSession, lines: DataFrame) -> DataFrame:
    src = landing_stream(spark, stage_lines(spark, lines))
    return run_to_parquet(hour_stream(minute_stream(src)), spark, "hour-stream")


def hour_change_sink(spark: SparkSession, landing_path: str, path: str, checkpoint_path: str, trigger: dict | None = None):
    """Landing lines -> minutes -> hours -> changes, appended as parquet; state and output survive restarts."""
    changes = hour_change_stream(hour_stream(minute_stream(landing_stream(spark, landing_path))))
    writer = changes.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint_path)
    with rocksdb_state(spark):
        return writer.trigger(**(trigger or {"availableNow": True})).start()


def minute_table_sink(spark: SparkSession, lake, landing_path: str, pending_path: str,
                      checkpoint_path: str, clean: bool = True, group_cols=None,
                      trigger: dict | None = None, max_files_per_trigger: int | None = None,
                      late_path: str | None = None):
    """SS5/SS6: micro-batches of landing lines -> minute table.

    Each micro-batch is the pending rows of the previous batch plus the new
    lines, and runs the batch job's steps: the full-minute cut over all of
    them, the watermark bound (SS4: a row at or before the newest stored
    minute is dropped and does not enter the quantiles), cleaning, rollup and
    the anti-join append. Rows later than the newest stored minute are the
    pending rows of the next batch, as the batch job reads their files again.

    Table reads and the append go through the micro-batch's own session, with
    the file listing refreshed first, so the anti-join sees what earlier
    batches appended; a replayed batch appends nothing twice. A pending folder
    that cannot be read fails the batch.

    SS4: with ``late_path``, each micro-batch writes how many of its own rows per
    device the watermark drops (``late_row_counts`` reads them); a replayed
    batch writes its counts anew."""
    from sensorlake.operators.quality import late_rows
    from sensorlake.operators.slices import after_watermark, full_periods
    from sensorlake.plans.jobs import ORDER_COLS, pinned
    from sensorlake.operators.clean import clean_batch
    from sensorlake.operators.rollup import minute_rollup
    from sensorlake.sources.tables import Lakehouse

    lake.create(MINUTE_TABLE_NAME)

    def process(batch: DataFrame, batch_id: int) -> None:
        bspark = batch.sparkSession
        own = Lakehouse(bspark, lake.database)
        own.refresh(MINUTE_TABLE_NAME)
        watermark = own.latest_timestamp(MINUTE_TABLE_NAME)
        rows = pinned(accepted(parse_lines(batch, keep=["file_name"])))  # read for the late rows, the cut, the cleaning and the pending rows
        if late_path:
            late_rows(rows, watermark).write.mode("overwrite").parquet(f"{late_path}/batch={batch_id}")
        if batch_id > 0:
            rows = bspark.read.parquet(f"{pending_path}/batch={batch_id - 1}").unionByName(rows)
        complete = after_watermark(full_periods(rows, "minute"), watermark)
        if clean:
            complete = clean_batch(complete, ORDER_COLS, FEATURES, group_cols)
        minutes = minute_rollup(complete, with_count=False)
        ok = stored_rows(pinned(storage_cast(minutes, MINUTE_TABLE)))
        new = append_new(ok, own.read(MINUTE_TABLE_NAME), bounds=date_bounds(ok))
        own.append(MINUTE_TABLE_NAME, with_partition_columns(new, batch_id))
        own.refresh(MINUTE_TABLE_NAME)
        pending = after_watermark(rows, own.latest_timestamp(MINUTE_TABLE_NAME))
        pending.write.mode("overwrite").parquet(f"{pending_path}/batch={batch_id}")
        lake.refresh(MINUTE_TABLE_NAME)  # readers of the caller's session
        if batch_id > 1:  # this batch may still be replayed, the one before it not
            _delete(bspark, f"{pending_path}/batch={batch_id - 2}")

    src = landing_stream(spark, landing_path, max_files_per_trigger)
    writer = src.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()


def late_row_counts(spark: SparkSession, late_path: str) -> DataFrame:
    """SS4: ``batch, device_id, late_rows`` of all micro-batches of a minute table sink."""
    rows = spark.read.schema("device_id string, late_rows long, batch long").parquet(late_path)
    return rows.select("batch", "device_id", "late_rows")


def landing_batch_sink(lines: DataFrame, path: str, pending_path: str, checkpoint_path: str,
                       records_per_file: int = LANDING_FILE_RECORDS, trigger: dict | None = None):
    """SS7/SK2: stream raw lines into labelled landing files of exactly ``records_per_file`` lines.

    A micro-batch is the pending lines of the previous one, then its own lines in the order of their
    timestamps. Full batches are written as by ``write_landing``; the lines of the last, unfilled batch
    are the pending lines of the next micro-batch (fewer than ``records_per_file`` lines, at any rate of
    arrival). ``close_landing_batches`` writes them when the stream has ended. A replayed micro-batch
    overwrites its own folder, so no line is written twice."""

    def process(batch: DataFrame, batch_id: int) -> None:
        bspark = batch.sparkSession
        rows = _in_order(batch.select("value"), F.lit(1))
        if batch_id > 0:
            rows = rows.unionByName(bspark.read.schema(_PENDING).parquet(f"{pending_path}/batch={batch_id - 1}"))
        _write_batches(rows, path, str(batch_id), f"{pending_path}/batch={batch_id}", records_per_file, close=False)
        if batch_id > 1:  # this batch may still be replayed, the one before it not
            _delete(bspark, f"{pending_path}/batch={batch_id - 2}")

    writer = lines.select("value").writeStream.foreachBatch(process).option("checkpointLocation", checkpoint_path)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def close_landing_batches(spark: SparkSession, path: str, pending_path: str, records_per_file: int = LANDING_FILE_RECORDS) -> None:
    """SS7: write the unfilled batch that an ended stream has left as its last landing file."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(pending_path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    batches = [int(s.getPath().getName().removeprefix("batch=")) for s in fs.listStatus(root)] if fs.exists(root) else []
    if batches:
        newest = f"{pending_path}/batch={max(batches)}"
        _write_batches(spark.read.schema(_PENDING).parquet(newest), path, f"{max(batches)}-end", newest, records_per_file, close=True)


_PENDING = "value string, carried int, at timestamp_ntz, place long"


def _in_order(lines: DataFrame, carried) -> DataFrame:
    """Raw lines with what orders them: carried ones first, then by timestamp; faulty ones go with the first."""
    from sensorlake.sources.landing import raw_line_timestamp

    return lines.select("value", carried.alias("carried"), raw_line_timestamp("value").alias("at"), F.lit(0).cast("long").alias("place"))


def _write_batches(rows: DataFrame, path: str, load: str, pending: str, records_per_file: int, close: bool) -> None:
    from sensorlake.operators.clean import row_index
    from sensorlake.sources.landing import write_landing

    indexed = row_index(rows, ["carried", "place", "at", "value"])
    total = indexed.count()
    full = total if close else total // records_per_file * records_per_file
    if full:
        write_landing(indexed.where(F.col("row_idx") <= full), path, batch_size=records_per_file, load=load)
    if not close:
        rest = indexed.where(F.col("row_idx") > full)
        rest.select("value", F.lit(0).alias("carried"), "at", F.col("row_idx").alias("place")).write.mode("overwrite").parquet(pending)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def landing_sink(lines: DataFrame, path: str, checkpoint_path: str,
                 records_per_file: int = LANDING_FILE_RECORDS, trigger: dict | None = None):
    """SS7: stream raw lines into landing text files of at most
    ``records_per_file`` lines (the bound holds per task and micro-batch)."""
    return (lines.select("value").writeStream.format("text")
            .option("path", path).option("checkpointLocation", checkpoint_path)
            .option("maxRecordsPerFile", records_per_file)
            .trigger(**(trigger or {"availableNow": True})).start())

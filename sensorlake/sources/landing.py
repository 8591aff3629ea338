"""Landing zone: raw text files of sensor lines (SC1-SC4, SC7, SK1, SK2, SO1).

A landing file is named after the timestamp of its last record
(``yyyy-MM-dd_HH_mm_ss.SSSSSS.txt``); files written by ``write_landing`` carry
that label as a ``day=<date>/batch=<label>`` directory instead, because Spark
does not choose file names. Either form is understood by ``read_landing``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorlake.functions.columns import (batch_label_from_line, epoch_to_timestamp, file_name_timestamp, float_text,
                                          label_timestamp, line_timestamp, timestamp_text, whitespace_tokens)
from sensorlake.schemas import FEATURES, HISTORY_CSV, LANDING_FILE_RECORDS, LANDING_NAME_FORMAT, RAW_LINE


def _file_time():
    """Landing time of a file: its name, else its ``batch=`` directory. It is worked out for every line, so
    the path is cut at its slashes; a regular expression tries every place of a long path."""
    path = F.col("file_path")
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    from_dir = label_timestamp(F.when(F.contains(folder, F.lit("batch=")), F.regexp_replace(folder, "^.*?batch=", "")))
    return F.coalesce(file_name_timestamp(path), from_dir)


def _paths_since(spark: SparkSession, path: str, since: _dt.datetime) -> list[str]:
    """What of a landing folder may hold files later than ``since``: its ``day=`` folders from that day
    on, or the folder itself if it holds files of its own. One listing of the top level."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root) or not fs.getFileStatus(root).isDirectory():
        return [path]
    names = [(s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(root)]
    days = [n for n, folder in names if folder and n.startswith("day=")]
    others = [n for n, _ in names if n not in days and not n.startswith(("_", "."))]
    if others or not days:
        return [path]
    late = [n for n in days if n[len("day="):] >= since.date().isoformat()]
    return [f"{path.rstrip('/')}/{n}" for n in sorted(late or days[-1:])]


def read_landing(spark: SparkSession, path: str | list[str], since: _dt.datetime | None = None,
                 recursive: bool = True) -> DataFrame:
    """SC1+SC2+SC3+SO1: one row per line of every landing file under ``path``.

    Columns: ``value`` (the raw line), ``file_path``, ``file_name``,
    ``file_time`` (NULL for a malformed name). With ``since``, only files whose
    name time is strictly later are read: of ``day=`` folders only those from
    that day on are listed, and the filter on the file's time drops the other
    files before any byte of them is read.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if since is not None:
        paths = [p for one in paths for p in _paths_since(spark, one, since)]
    reader = spark.read.schema(RAW_LINE)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
    ).withColumn("file_time", _file_time())
    if since is not None:
        df = df.where(F.col("file_time") > F.lit(since).cast("timestamp_ntz"))
    return df


def list_landing(spark: SparkSession, path: str, since: _dt.datetime | None = None) -> DataFrame:
    """SC1: one row per landing file, ``file_path, file_name, file_time, bytes``; no file is opened,
    and files without a byte are not listed.

    With ``since`` only the ``day=`` folders from that day on are listed."""
    paths = [path] if since is None else _paths_since(spark, path, since)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return files.select(F.col("path").alias("file_path"), F.regexp_extract("path", r"([^/]*)$", 1).alias("file_name"),
                        F.col("length").alias("bytes")).withColumn("file_time", _file_time())


def landing_files(lines: DataFrame) -> DataFrame:
    """SC1: one row per landing file with its line count and name time."""
    return lines.groupBy("file_path", "file_name", "file_time").agg(F.count("*").alias("lines"))


def rejected_files(lines: DataFrame) -> DataFrame:
    """Files whose name does not carry a valid timestamp (listed, not read as data)."""
    return landing_files(lines).where(F.col("file_time").isNull())


def batch_labels(lines: DataFrame, order_cols: list[str], index_col: str = "row_idx",
                 batch_size: int = LANDING_FILE_RECORDS) -> DataFrame:
    """SK2: label each batch of ``batch_size`` consecutive lines (by a dense
    1-based ``index_col``) with the first two tokens, joined by '_', of its last
    line with a valid timestamp; null without such a line."""
    batch = F.floor((F.col(index_col) - 1) / batch_size).alias("batch_no")
    return (lines.select(batch, F.when(raw_line_timestamp("value").isNotNull(), F.col(index_col)).alias("_at"), "value")
            .groupBy("batch_no")
            .agg(F.max_by("value", "_at").alias("last_line"),
                 F.count("*").alias("records"))
            .select("batch_no", F.when(F.col("last_line").isNotNull(), batch_label_from_line(F.col("last_line"))).alias("batch"), "records"))


def raw_line_timestamp(line: str):
    """The timestamp of a raw line; NULL when its first two tokens are none."""
    tokens = whitespace_tokens(F.col(line))
    return line_timestamp(F.try_element_at(tokens, F.lit(1)), F.try_element_at(tokens, F.lit(2)))


def write_landing(lines: DataFrame, path: str, index_col: str = "row_idx",
                  batch_size: int = LANDING_FILE_RECORDS, mode: str = "append", load: str | None = None) -> None:
    """SK1+SK2: write lines (with a dense 1-based ``index_col`` in arrival
    order) as files of at most ``batch_size`` records, one file per batch, each
    in a ``day=<date>/batch=<label>`` directory. The label is the timestamp of
    the batch's last line that has a valid one, so a faulty line at its end
    does not make the batch unreadable; a batch without any valid timestamp is
    written as ``day=none/batch=none-<number>`` and refused by the loads.
    With ``load`` the folders are ``day=<date>/load=<load>/batch=<label>``, and
    what the same load has written there before is replaced.

    One shuffle: a batch's rows meet in a task, which also labels them. Its partitions are not joined to fewer
    by their bytes: the time goes into the files, and short batches would all be written by one task."""
    batch = F.floor((F.col(index_col) - 1) / batch_size)
    rows = lines.select("value", index_col, batch.alias("batch_no"), raw_line_timestamp("value").alias("_ts"))
    rows = rows.repartition(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), "batch_no")
    own = Window.partitionBy("batch_no")
    last = F.max_by("_ts", F.when(F.col("_ts").isNotNull(), F.col(index_col))).over(own)
    out = (rows.withColumn("_last", last)
           # ':' is not a portable path character (file sources cannot read it back)
           .withColumn("batch", F.coalesce(F.date_format("_last", LANDING_NAME_FORMAT), F.concat(F.lit("none-"), F.col("batch_no"))))
           .withColumn("day", F.coalesce(F.date_format("_last", "yyyy-MM-dd"), F.lit("none")))
           .sortWithinPartitions("day", "batch", index_col)
           .select("value", "day", "batch"))
    if load is None:
        out.write.option("maxRecordsPerFile", batch_size).mode(mode).partitionBy("day", "batch").text(path)
    else:
        out = out.select("value", "day", F.lit(load).alias("load"), "batch")
        (out.write.option("maxRecordsPerFile", batch_size).option("partitionOverwriteMode", "dynamic")
         .mode("overwrite").partitionBy("day", "load", "batch").text(path))


def read_history_csv(spark: SparkSession, path: str) -> DataFrame:
    """SC4: headered historical CSV, columns resolved by header name (the
    column order of the file is not known), typed by ``HISTORY_CSV``."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    present = {c.lower(): c for c in raw.columns}
    return raw.select(*[
        (F.col(f"`{present[f.name]}`").try_cast(f.dataType) if f.name in present
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in HISTORY_CSV.fields])


def history_to_lines(history: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """PJ2+PJ3+SF5+SF9: historical rows -> raw landing lines (UTC).
    A missing feature or light is written as ``nan``, so the line keeps its
    nine tokens. ``keep`` columns are passed through beside each line."""
    ts = epoch_to_timestamp(F.col("ts"))
    feats = {"co": "co", "humidity": "humidity", "lpg": "lpg", "smoke": "smoke", "temperature": "temp"}
    line = F.concat_ws(" ", timestamp_text(ts), F.col("device"),
                       *[F.coalesce(float_text(F.col(feats[f])), F.lit("nan")) for f in FEATURES],
                       F.coalesce(F.col("light").cast("int").cast("string"), F.lit("nan")))
    return history.select(*(keep or []), ts.alias("timestamp"), F.col("device").alias("device_id"),
                          line.alias("value"))

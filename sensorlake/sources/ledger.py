"""Ledger of the landing files (SC1, SC3): what became of every file that a load has seen.

A load lists the landing folder, takes the files that the ledger does not hold yet (an
anti-join on the path), and writes one row for each before it stores any minute:

* ``loaded``: the name's time is later than the table's watermark, so the load reads it;
* ``late``: the name's time is not later than the watermark. All its readings would be dropped,
  so the file is not read, but it is named here;
* ``refused``: the name carries no valid time. The file is not read as data by any load.

For loaded files the row counts the lines, those that the parser rejects, and the accepted ones
at or before the watermark, which the load drops (SS4). A load that fails after its ledger rows
are written reads the same files again, as it goes by the watermark and not by the ledger.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.operators.parse import parse_lines

LOADED, LATE, REFUSED = "loaded", "late", "refused"


def unseen_files(listing: DataFrame, ledger: DataFrame, since: _dt.datetime | None = None) -> DataFrame:
    """The listed files without a row in the ledger. With ``since``, the day from which folders were listed,
    only the ledger's partitions from that day on, and that of the refused files, are read."""
    if since is not None:
        ledger = ledger.where((F.col("dt") >= F.lit(since.date())) | F.col("dt").isNull())
    return listing.join(ledger.select("file_path"), "file_path", "left_anti")


def with_status(files: DataFrame, watermark: _dt.datetime | None) -> DataFrame:
    """Files with ``status`` and the ``watermark`` that decided it."""
    mark = F.lit(watermark).cast("timestamp_ntz")
    status = (F.when(F.col("file_time").isNull(), F.lit(REFUSED))
              .when(F.col("file_time") <= mark, F.lit(LATE)).otherwise(F.lit(LOADED)))
    return files.withColumn("status", status).withColumn("watermark", mark)


def line_account(lines: DataFrame, watermark: _dt.datetime | None) -> DataFrame:
    """Per file: lines, lines that the parser rejects, and accepted lines at or before the watermark."""
    parsed = parse_lines(lines, keep=["file_path"])
    late = F.col("reject").isNull() & (F.col("timestamp") <= F.lit(watermark).cast("timestamp_ntz"))
    return parsed.groupBy("file_path").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(F.col("reject").isNotNull()).alias("rejected_lines"),
        F.count_if(F.coalesce(late, F.lit(False))).alias("late_lines"))


def ledger_rows(listing: DataFrame, ledger: DataFrame, lines: DataFrame, watermark: _dt.datetime | None,
                ingest_seq: int, since: _dt.datetime | None = None) -> DataFrame:
    """The rows that a load adds to the ledger; ``lines`` are those it reads."""
    files = with_status(unseen_files(listing, ledger, since), watermark)
    counted = files.join(line_account(lines, watermark), "file_path", "left")
    return counted.select("file_path", "file_name", "file_time", "bytes", "status", "watermark", "lines", "rejected_lines", "late_lines",
                          F.lit(ingest_seq).cast("bigint").alias("ingest_seq"), F.to_date("file_time").alias("dt"))

"""Lakehouse tables: DDL, existence probes, scans and appends (SK3-SK9, SC5, SC6).

Tables are parquet catalog tables partitioned by ``dt`` (the UTC date of the
row's timestamp), with an ``ingest_seq`` load id. The minute table is named
``dds_iot_data`` and the marts ``dm_iot_average``, ``dm_iot_extreme``,
``dm_iot_count`` and ``dm_iot_ml`` as in the source system; ``landing_files`` is the
ledger of the landing files (``sources.ledger``).
"""

from __future__ import annotations

import contextlib
import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.schemas import FILE_LEDGER_NAME, KEYS, MART_NAMES, MINUTE_TABLE_NAME, ddl_columns, table_schema

TABLES = [MINUTE_TABLE_NAME, *MART_NAMES, FILE_LEDGER_NAME]
COMMITS = "mart_commits"


class Lakehouse:
    """Catalog tables of one deployment, optionally inside ``database``.

    With ``buckets`` the minute table and the marts are bucketed by their key, so that the anti-join of an
    append reads the stored keys of a day where they lie, without a shuffle of the stored side; only the new
    rows are shuffled, to the same buckets, for the join and for the write."""

    def __init__(self, spark: SparkSession, database: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.database = database
        self.buckets = buckets
        if database:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`" if self.database else f"`{table}`"

    # --- DDL ------------------------------------------------------------------
    def create(self, table: str) -> None:
        """SK5/SK6: idempotent CREATE TABLE with the declared storage types."""
        cols = ddl_columns(table_schema(table))
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(table)} "
            f"({cols}, `ingest_seq` BIGINT, `dt` DATE) USING parquet PARTITIONED BY (dt)" + self._clustered(table))

    def _clustered(self, table: str) -> str:
        keys = ", ".join(KEYS)
        return f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS" if self.buckets and table != FILE_LEDGER_NAME else ""

    def create_all(self) -> None:
        for t in TABLES:
            self.create(t)

    def drop(self, table: str) -> None:
        """SK7/SK8."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")

    def drop_all(self) -> None:
        for t in [*TABLES, COMMITS]:
            self.drop(t)

    def drop_database(self) -> None:
        """The tables and the database itself."""
        self.drop_all()
        if self.database:
            self.spark.sql(f"DROP DATABASE IF EXISTS `{self.database}` CASCADE")

    def exists(self, table: str) -> bool:
        """SK9."""
        return self.spark.catalog.tableExists(f"{self.database}.{table}" if self.database else table)

    def refresh(self, table: str) -> None:
        """Forget this session's cached file listing of a table that another session wrote."""
        self.spark.catalog.refreshTable(self.name(table))

    # --- publication (SK4) --------------------------------------------------------
    def commit(self, ingest_seq: int) -> None:
        """Publish what all loads up to ``ingest_seq`` have appended to the marts: one record, whose write is
        the only step that readers of ``read_published`` can see."""
        name = self.name(COMMITS)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (committed_at TIMESTAMP_NTZ, ingest_seq BIGINT) USING parquet PARTITIONED BY (ingest_seq)")
        row = self.spark.range(1).select(F.current_timestamp().cast("timestamp_ntz").alias("committed_at"), F.lit(ingest_seq).cast("bigint").alias("ingest_seq"))
        row.write.insertInto(name)

    def published_seq(self) -> int | None:
        """The newest commit, from the catalog's partition list; None when nothing was published."""
        if not self.exists(COMMITS):
            return None
        parts = [r[0] for r in self.spark.sql(f"SHOW PARTITIONS {self.name(COMMITS)}").collect()]
        return max((int(p.split("=", 1)[1]) for p in parts), default=None)

    def read_published(self, table: str) -> DataFrame:
        """A mart as of the newest commit. The four marts change together: rows of a load that has not
        committed, or has failed between two marts, are not seen. The load after a failed one completes its
        hours and publishes them with its own."""
        seq = self.published_seq()
        return self.read(table).where(F.col("ingest_seq") <= F.lit(seq) if seq is not None else F.lit(False))

    # --- compaction (SK3) -----------------------------------------------------------
    def files(self, table: str) -> DataFrame:
        """``dt, files, rows`` of every partition."""
        rows = self.read(table).select("dt", F.col("_metadata.file_path").alias("file"))
        return rows.groupBy("dt").agg(F.count_distinct("file").alias("files"), F.count("*").alias("rows"))

    def compact(self, table: str, most_files: int = 8, rows_per_file: int = 5_000_000) -> int:
        """Rewrite the partitions that hold more than ``most_files`` files; returns how many there were.

        Appends of one run every 15 minutes leave a day in hundreds of small files. A partition's rows are
        pinned outside the table first and then replace the partition as a whole, so a failed rewrite loses
        nothing. A file holds at most ``rows_per_file`` rows, or a bucket, if the table has buckets; the rows
        of a day are spread by their key."""
        from sensorlake.session import ensure_checkpoint_dir

        many = self.files(table).where(F.col("files") > most_files)
        days = {r["dt"]: max(1, -(-r["rows"] // rows_per_file)) for r in many.collect()}  # one row per day
        ensure_checkpoint_dir(self.spark)
        for day, pieces in days.items():
            here = F.col("dt").eqNullSafe(F.lit(day))
            rows = self.read(table).where(here).checkpoint(eager=True)
            order = [f.name for f in table_schema(table).fields][:2]
            packed = rows.repartition(self.buckets, *KEYS) if self._clustered(table) else rows.repartitionByRange(pieces, *order)
            packed = packed.sortWithinPartitions(*order).select(*self.read(table).columns)
            with self._replacing_partitions():
                packed.write.insertInto(self.name(table), overwrite=True)
            self.refresh(table)
        return len(days)

    @contextlib.contextmanager
    def _replacing_partitions(self):
        """An overwrite replaces, when its job commits, the partitions it has written, and no others."""
        key = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(key)
        self.spark.conf.set(key, "dynamic")
        try:
            yield
        finally:
            self.spark.conf.set(key, before)

    # --- watermarks ------------------------------------------------------------------
    def newest_partition(self, table: str):
        """Newest ``dt`` partition from the catalog's partition list (metadata
        only: one entry per day, no data file is opened). None when empty."""
        parts = [r[0] for r in self.spark.sql(f"SHOW PARTITIONS {self.name(table)}").collect()]
        days = [p.split("=", 1)[1] for p in parts if p.startswith("dt=")]
        return _dt.date.fromisoformat(max(days)) if days else None

    def latest_timestamp(self, table: str) -> _dt.datetime | None:
        """AG11: ``MAX(timestamp)`` read from the newest partition only."""
        newest = self.newest_partition(table)
        if newest is None:
            return None
        return (self.read(table).where(F.col("dt") == F.lit(newest))
                .agg(F.max("timestamp").alias("wm")).first()["wm"])

    # --- scans and appends -------------------------------------------------------
    def read(self, table: str) -> DataFrame:
        """SC5/SC6: the table as a DataFrame (filters on ``timestamp`` and ``dt``
        reach the parquet scan and the partition listing)."""
        return self.spark.table(self.name(table))

    def append(self, table: str, rows: DataFrame) -> None:
        """SK3/SK4: append rows that already carry ``ingest_seq`` and ``dt``;
        columns are projected into the declared order first."""
        cols = [f.name for f in table_schema(table).fields] + ["ingest_seq", "dt"]
        rows = rows.select(*[F.col(c) for c in cols])
        if self._clustered(table):  # one file for each bucket and day
            rows = rows.repartition(self.buckets, *KEYS)
        rows.write.insertInto(self.name(table))

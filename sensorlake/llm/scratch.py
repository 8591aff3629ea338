"""Intermediate tables in the shared folder that ``spark.checkpoint.dir`` names.

``pin`` writes a frame as Parquet below the session's checkpoint folder and
reads it back, so lineage ends there and a lost executor costs a re-read, not a
recomputation.  ``release`` deletes what a session has pinned; call it when the
results that read those tables have been written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from sensorlake.session import ensure_checkpoint_dir


def _root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/llm-{spark.sparkContext.applicationId}"


def pin(df: DataFrame, name: str = "table", rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` to the shared scratch folder and return the written table.

    ``rows_per_file`` bounds the rows of a file, and so of a read batch, for rows of megabytes."""
    spark = df.sparkSession
    path = f"{_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession, groups: int) -> int:
    """Partitions for ``groups`` heavy groups: some for each, so that few share one, but no more than
    four times the session's shuffle partitions, which are set to the size of the cluster."""
    return min(4 * groups, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def release(spark: SparkSession) -> None:
    """Delete every table this application has pinned."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

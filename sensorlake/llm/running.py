"""Distributed running totals: a prefix sum whose groups never meet in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_total(df: DataFrame, value: str, within: list[str], levels: list[list[str]],
                  order: list[str | Column], out: str = "before", attach: DataFrame | None = None) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows that precede a row within its group.

    Rows are ordered by the columns of ``levels``, level by level, and then by
    ``order``.  Only the rows of one innermost bucket (``within`` plus all levels)
    meet in a task; the buckets' sums are added up level by level, so a window
    sees one row for each bucket of its parent.  All key columns must be non-null.
    ``attach`` (one row per ``within``) reaches the rows by way of the buckets, so that
    no join deals the rows of a hot group to one task.
    """
    flat = [c for level in levels for c in level]
    sums = df.groupBy(*within, *flat).agg(F.sum(value).alias("_sum"))
    offsets, keys = None, list(within)
    for i, level in enumerate(levels):
        here = sums if i == len(levels) - 1 else sums.groupBy(*keys, *level).agg(F.sum("_sum").alias("_sum"))
        over = Window.partitionBy(*keys).orderBy(*level).rowsBetween(Window.unboundedPreceding, -1)
        here = here.withColumn("_before", F.coalesce(F.sum("_sum").over(over), F.lit(0))).drop("_sum")
        if offsets is None:
            here = here if attach is None else here.join(attach, within)
        else:
            here = here.join(offsets, keys).withColumn("_before", F.col("_before") + F.col("_outer")).drop("_outer")
        keys += level
        offsets = here.withColumnRenamed("_before", "_outer")
    bucket = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (df.withColumn("_own", F.sum(value).over(bucket) - F.col(value))
            .join(offsets, keys)
            .withColumn(out, F.col("_own") + F.col("_outer")).drop("_own", "_outer"))

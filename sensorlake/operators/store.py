"""Storage casts and idempotent appends (PJ5, SF14, JN2, JN3, WN1, FL10, Q1-Q4).

The reference inserts rows and then deletes every later copy of a key. Here
the new rows are anti-joined against the stored keys of the affected date
partitions *before* the append, so readers never see duplicates and the
stored row always wins. Rows that do not fit the declared storage types are
returned as rejects with a reason instead of failing the load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.schemas import DEVICE_ID_MAX_LEN, KEYS, LIGHT_DOMAIN


def storage_cast(df: DataFrame, schema: T.StructType) -> DataFrame:
    """PJ5/SF14 + Q1-Q4: cast every column to its storage type (half-up
    rounding, NULL on overflow) and add ``reject``:

    * ``null``   - a NOT NULL column is NULL (keys, light, counts);
    * ``domain`` - light outside {0, 1};
    * ``length`` - device id longer than 17 characters;
    * ``range``  - a non-NULL value overflows its decimal type.
    """
    cols, checks = [], []
    for f in schema.fields:
        src = F.col(f.name)
        dst = src.try_cast(f.dataType)
        cols.append(dst.alias(f.name))
        if not f.nullable:
            checks.append((src.isNull(), "null"))
        if f.name == "light" and isinstance(f.dataType, T.ShortType):
            checks.append((~src.isin(*LIGHT_DOMAIN), "domain"))
        if f.name == "device_id":
            checks.append((F.length(src) > DEVICE_ID_MAX_LEN, "length"))
        if isinstance(f.dataType, T.DecimalType):
            checks.append((src.isNotNull() & dst.isNull(), "range"))
    reason = F.lit(None).cast("string")
    for cond, name in reversed(checks):
        reason = F.when(cond, F.lit(name)).otherwise(reason)
    return df.select(*cols, reason.alias("reject"))


def stored_rows(cast: DataFrame) -> DataFrame:
    return cast.where(F.col("reject").isNull()).drop("reject")


def storage_rejects(cast: DataFrame) -> DataFrame:
    return cast.where(F.col("reject").isNotNull())


def date_bounds(df: DataFrame, ts_col: str = "timestamp"):
    """(min date, max date) of a batch as two scalars, for partition pruning."""
    r = df.agg(F.min(ts_col).alias("lo"), F.max(ts_col).alias("hi")).first()
    if r["lo"] is None:
        return None, None
    return r["lo"].date(), r["hi"].date()


def append_new(new: DataFrame, existing: DataFrame | None, keys: list[str] = KEYS,
               bounds=None) -> DataFrame:
    """JN3: rows of ``new`` whose key is not stored yet (stored row wins).

    ``bounds`` (min, max date of ``new``) restricts the stored side to the
    affected ``dt`` partitions, so the anti-join reads only those partitions
    instead of the table; Spark picks the join strategy from their size.
    """
    if existing is None:
        return new
    stored = existing
    if bounds is not None and "dt" in existing.columns:
        lo, hi = bounds
        if lo is None:
            return new
        stored = stored.where(F.col("dt").between(F.lit(lo), F.lit(hi)))
    return new.join(stored.select(*keys), keys, "left_anti")


def dedupe_first(df: DataFrame, keys: list[str] = KEYS, order_col: str = "ingest_seq") -> DataFrame:
    """WN1/FL10/JN2: keep the first copy of every key by ``order_col``; among
    copies of one load, the least by all their columns, so reruns agree.

    ``min`` of a struct is an aggregate, so copies of a hot key are reduced on the
    map side before the shuffle instead of being collected into one window task.
    """
    others = [c for c in df.columns if c not in keys]
    ranked = [order_col, *[c for c in others if c != order_col]]
    first = F.min(F.struct(*[F.col(c) for c in ranked])).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, *[F.col(f"_first.{c}").alias(c) for c in others])


def with_partition_columns(df: DataFrame, ingest_seq: int, ts_col: str = "timestamp") -> DataFrame:
    """Add the load id and the ``dt`` date partition column."""
    return df.withColumn("ingest_seq", F.lit(ingest_seq).cast("bigint")).withColumn(
        "dt", F.to_date(F.col(ts_col)))

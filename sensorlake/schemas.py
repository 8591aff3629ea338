"""Schemas, feature lists and storage types of the lakehouse tables.

The column lists and storage precisions below are fixed values of the data
model (minute table and four hourly marts); they must not change.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: feature names, keys, storage precisions -----------------
FEATURES = ["co", "humidity", "lpg", "smoke", "temperature"]
KEYS = ["timestamp", "device_id"]
DEVICE_ID_MAX_LEN = 17
LIGHT_DOMAIN = (0, 1)
EXPECTED_MINUTES_PER_HOUR = 60
LANDING_FILE_RECORDS = 1000
LANDING_NAME_FORMAT = "yyyy-MM-dd_HH_mm_ss.SSSSSS"
RAW_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# storage precision of each feature in the minute table (and of hourly
# means / extremes / medians / changes in the marts)
FEATURE_DECIMAL = {
    "co": (12, 10),
    "humidity": (5, 1),
    "lpg": (12, 10),
    "smoke": (12, 10),
    "temperature": (5, 1),
}
# variance columns of the ML mart
VARIANCE_DECIMAL = {
    "co": (12, 10),
    "humidity": (5, 2),
    "lpg": (12, 10),
    "smoke": (12, 10),
    "temperature": (5, 2),
}
RATIO_DECIMAL = (12, 10)
PERCENT_DECIMAL = (5, 2)
LIGHT_MEAN_DECIMAL = (5, 2)

# ratio columns of the ML mart: name -> (numerator mean, denominator mean)
RATIOS = {
    "co_to_humidity_ratio": ("co", "humidity"),
    "smoke_to_temperature_ratio": ("smoke", "temperature"),
    "lpg_to_co_ratio": ("lpg", "co"),
}
# --- end of fixed values ----------------------------------------------------


def dec(p_s: tuple[int, int]) -> T.DecimalType:
    return T.DecimalType(*p_s)


# One raw landing line (D1).
RAW_LINE = T.StructType([T.StructField("value", T.StringType())])

# Historical CSV (D10): read by header name, motion is present but unused.
HISTORY_CSV = T.StructType([
    T.StructField("ts", T.DoubleType()),
    T.StructField("device", T.StringType()),
    T.StructField("co", T.DoubleType()),
    T.StructField("humidity", T.DoubleType()),
    T.StructField("light", T.BooleanType()),
    T.StructField("lpg", T.DoubleType()),
    T.StructField("motion", T.BooleanType()),
    T.StructField("smoke", T.DoubleType()),
    T.StructField("temp", T.DoubleType()),
])

# Minute table (D6). `dt` is the date partition, `ingest_seq` the load id
# that orders copies of a key (keep-first).
MINUTE_TABLE = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType(), False),
    T.StructField("device_id", T.StringType(), False),
    *[T.StructField(f, dec(FEATURE_DECIMAL[f]), False) for f in FEATURES],
    T.StructField("light", T.ShortType(), False),
])

MART_COLUMNS = {
    "dm_iot_average": KEYS + FEATURES + ["light"],
    "dm_iot_extreme": KEYS + [f"{m}_{f}" for f in FEATURES for m in ("max", "min")],
    "dm_iot_count": KEYS + ["record_count"],
    "dm_iot_ml": KEYS
    + [f"{s}_{f}" for f in FEATURES for s in ("mean", "median", "variance")]
    + [f"{f}_change_last_hour" for f in FEATURES]
    + list(RATIOS)
    + [f"variance_to_mean_{f}" for f in FEATURES]
    + [f"high_low_percentage_{f}" for f in FEATURES],
}
MINUTE_TABLE_NAME = "dds_iot_data"

# Ledger of the landing files: one row per file, written by the load that first saw it. `dt` is the
# date of the file's name time (null for a refused file).
FILE_LEDGER = T.StructType([
    T.StructField("file_path", T.StringType(), False),
    T.StructField("file_name", T.StringType(), False),
    T.StructField("file_time", T.TimestampNTZType()),
    T.StructField("bytes", T.LongType()),
    T.StructField("status", T.StringType(), False),
    T.StructField("watermark", T.TimestampNTZType()),
    T.StructField("lines", T.LongType()),
    T.StructField("rejected_lines", T.LongType()),
    T.StructField("late_lines", T.LongType()),
])
FILE_LEDGER_NAME = "landing_files"
MART_NAMES = list(MART_COLUMNS)


def mart_storage_type(table: str, column: str) -> T.DataType:
    """Declared storage type of a mart column."""
    if column == "timestamp":
        return T.TimestampNTZType()
    if column == "device_id":
        return T.StringType()
    if column == "record_count":
        return T.IntegerType()
    if table == "dm_iot_average" and column == "light":
        return dec(LIGHT_MEAN_DECIMAL)
    if column in FEATURE_DECIMAL:
        return dec(FEATURE_DECIMAL[column])
    for f in FEATURES:
        if column in (f"max_{f}", f"min_{f}", f"mean_{f}", f"median_{f}",
                      f"{f}_change_last_hour"):
            return dec(FEATURE_DECIMAL[f])
        if column == f"variance_{f}":
            return dec(VARIANCE_DECIMAL[f])
        if column == f"variance_to_mean_{f}":
            return dec(RATIO_DECIMAL)
        if column == f"high_low_percentage_{f}":
            return dec(PERCENT_DECIMAL)
    if column in RATIOS:
        return dec(RATIO_DECIMAL)
    raise KeyError(f"{table}.{column}")


def mart_nullable(column: str) -> bool:
    """Only what one minute or the first hour cannot give: variances, their ratios, and changes."""
    return column.startswith("variance_") or column.endswith("_change_last_hour")


def mart_schema(table: str) -> T.StructType:
    return T.StructType([
        T.StructField(c, mart_storage_type(table, c), mart_nullable(c))
        for c in MART_COLUMNS[table]
    ])


def table_schema(table: str) -> T.StructType:
    fixed = {MINUTE_TABLE_NAME: MINUTE_TABLE, FILE_LEDGER_NAME: FILE_LEDGER}
    return fixed[table] if table in fixed else mart_schema(table)


def ddl_columns(schema: T.StructType) -> str:
    """Column list for CREATE TABLE; device ids are VARCHAR(17) like the source."""
    parts = []
    for f in schema.fields:
        typ = f"VARCHAR({DEVICE_ID_MAX_LEN})" if f.name == "device_id" else f.dataType.simpleString()
        parts.append(f"`{f.name}` {typ}" + ("" if f.nullable else " NOT NULL"))
    return ", ".join(parts)

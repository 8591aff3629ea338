import datetime as dt

from pyspark.sql import functions as F

from sensorlake.schemas import FEATURES


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def line(t: str, dev: str, co="0.004", hum="50.0", lpg="0.006", smoke="0.02", temp="22.5", light="0") -> str:
    return " ".join([t, dev, str(co), str(hum), str(lpg), str(smoke), str(temp), str(light)])


def lines_df(spark, lines, file_name=""):
    return spark.createDataFrame([(v,) for v in lines], "value string").withColumn("file_name", F.lit(file_name))


def minute_rows(spark, rows):
    """rows: (timestamp, device, co, humidity, lpg, smoke, temperature, light) as text -> DDS-shaped frame."""
    df = spark.createDataFrame([tuple(str(v) for v in r) for r in rows],
                               "timestamp string, device_id string, co string, humidity string, "
                               "lpg string, smoke string, temperature string, light string")
    return df.select(
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "device_id",
        F.col("co").cast("decimal(12,10)").alias("co"), F.col("humidity").cast("decimal(5,1)").alias("humidity"),
        F.col("lpg").cast("decimal(12,10)").alias("lpg"), F.col("smoke").cast("decimal(12,10)").alias("smoke"),
        F.col("temperature").cast("decimal(5,1)").alias("temperature"), F.col("light").cast("int").alias("light"))


def by_key(rows, key=("timestamp", "device_id")):
    return {tuple(r[k] for k in key): r for r in rows}


__all__ = ["ts", "line", "lines_df", "minute_rows", "by_key", "FEATURES"]

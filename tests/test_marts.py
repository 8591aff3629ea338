"""Minute and hourly rollups: mode ties, constant hours, gaps, zero means."""
from pyspark.sql import functions as F

from sensorlake.operators.marts import all_marts, hourly_stats, ml_mart
from sensorlake.operators.rollup import minute_rollup
from sensorlake.operators.store import dedupe_first

from helpers import by_key, minute_rows, ts

D = "b8:27:eb:bf:9d:51"


def test_light_mode_tie_is_zero(spark):
    df = spark.createDataFrame([(ts("2020-01-01 00:00:01"), D, 1.0, 1), (ts("2020-01-01 00:00:02"), D, 3.0, 0),
                                (ts("2020-01-01 00:01:02"), D, 3.0, 1)],
                               "timestamp timestamp_ntz, device_id string, co double, light int")
    out = minute_rollup(df, ["co"]).orderBy("timestamp").collect()
    assert [(r["co"], r["light"], r["raw_rows"]) for r in out] == [(2.0, 0, 2), (3.0, 1, 1)]


def _hour(minute, dev=D, co="0.004", hum="50.0", temp="22.6", light=0):
    return (f"2020-01-01 {minute}", dev, co, hum, "0.006", "0.02", temp, light)


def test_constant_hour_has_zero_above_mean_and_variance(spark):
    rows = [_hour(f"00:{m:02d}:00") for m in range(60)]
    ml = ml_mart(hourly_stats(minute_rows(spark, rows))).collect()[0]
    assert ml["high_low_percentage_temperature"] == 0.0
    assert ml["variance_temperature"] == 0.0
    assert ml["mean_temperature"] == 22.6


def test_one_minute_hour(spark):
    ml = ml_mart(hourly_stats(minute_rows(spark, [_hour("03:10:00", temp="21.4")]))).collect()[0]
    assert ml["variance_temperature"] is None and ml["variance_to_mean_temperature"] is None
    assert ml["median_temperature"] == 21.4


def test_change_spans_missing_hour_and_zero_mean_ratio(spark):
    rows = [_hour("00:00:00", temp="10.0"), _hour("02:00:00", temp="12.5"), _hour("03:00:00", temp="0.0")]
    ml = {r["timestamp"]: r for r in ml_mart(hourly_stats(minute_rows(spark, rows))).collect()}
    assert ml[ts("2020-01-01 00:00:00")]["temperature_change_last_hour"] is None
    assert ml[ts("2020-01-01 02:00:00")]["temperature_change_last_hour"] == 2.5
    assert ml[ts("2020-01-01 03:00:00")]["smoke_to_temperature_ratio"] is None


def test_marts_share_one_aggregate(spark):
    rows = [_hour(f"00:{m:02d}:00", co=f"0.00{m % 3 + 1}") for m in range(0, 60, 10)]
    marts = all_marts(hourly_stats(minute_rows(spark, rows)))
    assert marts["dm_iot_count"].collect()[0]["record_count"] == 6
    ext = marts["dm_iot_extreme"].collect()[0]
    assert (ext["max_co"], ext["min_co"]) == (0.003, 0.001)
    avg = marts["dm_iot_average"].collect()[0]
    assert abs(avg["co"] - 0.002) < 1e-15 and avg["light"] == 0.0
    assert marts["dm_iot_ml"].collect()[0]["high_low_percentage_co"] == 100.0 * 2 / 6


def test_keep_first_dedupe_keeps_lowest_sequence(spark):
    df = spark.createDataFrame([(ts("2020-01-01 00:00:00"), D, 3, 1.0), (ts("2020-01-01 00:00:00"), D, 1, 2.0),
                                (ts("2020-01-01 00:01:00"), D, 2, 3.0)],
                               "timestamp timestamp_ntz, device_id string, ingest_seq int, co double")
    got = by_key(dedupe_first(df).collect())
    assert got[(ts("2020-01-01 00:00:00"), D)]["co"] == 2.0 and len(got) == 2


def test_hours_without_any_record_have_zero_completeness(spark):
    from sensorlake.operators.quality import calendar_completeness
    rows = spark.createDataFrame([("2020-01-01 00:00:00", "a", 60), ("2020-01-01 03:00:00", "a", 59), ("2020-01-01 02:00:00", "b", 60)],
                                 "timestamp string, device_id string, record_count int")
    rows = rows.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    got = {(str(r["timestamp"])[11:13], r["device_id"]): (r["record_count"], round(r["completeness_pct"], 2)) for r in calendar_completeness(rows).collect()}
    assert got == {("01", "a"): (0, 0.0), ("02", "a"): (0, 0.0), ("03", "a"): (59, 98.33), ("03", "b"): (0, 0.0)}
    assert calendar_completeness(rows, only_incomplete=False).count() == 6
    assert calendar_completeness(rows.limit(0)).count() == 0

"""Goldens from the reference's own data files (FIXTURES.md section 2)."""
import math
import os
from decimal import Decimal

from pyspark.sql import functions as F

from sensorlake.operators.marts import hourly_stats, ml_mart
from sensorlake.operators.store import storage_cast, stored_rows
from sensorlake.plans.jobs import minute_batch
from sensorlake.schemas import MINUTE_TABLE
from sensorlake.sources.landing import read_landing

from conftest import FIXTURES
from helpers import ts

# expected minute rows of the sample landing file (FIXTURES.md 2.1)
EXPECTED = """
2020-07-19 23:58:00|00:0f:00:70:91:0a|0.0037371821|75.5|0.0062377957|0.0164114546|19.3|0
2020-07-19 23:58:00|1c:bf:ce:15:ec:4d|0.0045307016|75.9|0.0071700757|0.0190442571|26.7|1
2020-07-19 23:58:00|b8:27:eb:bf:9d:51|0.0059003542|49.5|0.0086797513|0.0233563814|22.6|0
2020-07-19 23:59:00|00:0f:00:70:91:0a|0.0037446280|73.0|0.0062467963|0.0164367444|20.2|0
2020-07-19 23:59:00|1c:bf:ce:15:ec:4d|0.0044961080|75.9|0.0071304100|0.0189317501|26.6|1
2020-07-19 23:59:00|b8:27:eb:bf:9d:51|0.0057852173|49.5|0.0085512594|0.0229901969|22.7|0
2020-07-20 00:00:00|00:0f:00:70:91:0a|0.0037431157|75.5|0.0062449511|0.0164315682|19.3|0
2020-07-20 00:00:00|1c:bf:ce:15:ec:4d|0.0045135552|75.8|0.0071504348|0.0189885382|26.6|1
2020-07-20 00:00:00|b8:27:eb:bf:9d:51|0.0058860881|49.4|0.0086645637|0.0233127296|22.7|0
2020-07-20 00:01:00|00:0f:00:70:91:0a|0.0037469783|75.4|0.0064971977|0.0164446716|19.3|0
2020-07-20 00:01:00|1c:bf:ce:15:ec:4d|0.0045313091|74.3|0.0071707678|0.0190462225|26.6|1
2020-07-20 00:01:00|b8:27:eb:bf:9d:51|0.0058850413|49.6|0.0086634455|0.0233095175|22.6|0
2020-07-20 00:02:00|00:0f:00:70:91:0a|0.0037474688|75.4|0.0062502202|0.0164463699|19.3|0
2020-07-20 00:02:00|1c:bf:ce:15:ec:4d|0.0045300330|75.4|0.0071693002|0.0190420620|26.6|1
2020-07-20 00:02:00|b8:27:eb:bf:9d:51|0.0058970911|49.2|0.0086762747|0.0233463903|22.4|0
"""
RAW_ROWS = [6, 6, 9, 10, 9, 16, 7, 8, 17, 10, 8, 16, 12, 10, 16]


def _stored_minutes(spark, partitions):
    lines = read_landing(spark, os.path.join(FIXTURES, "landing"))
    minutes = minute_batch(lines, None, clean=True, num_partitions=partitions)
    return stored_rows(storage_cast(minutes, MINUTE_TABLE))


def _expected():
    out = []
    for row in EXPECTED.strip().splitlines():
        t, d, co, h, lpg, sm, te, li = row.split("|")
        out.append((ts(t), d, Decimal(co), Decimal(h), Decimal(lpg), Decimal(sm), Decimal(te), int(li)))
    return sorted(out)


def test_landing_file_to_minutes_on_any_partitioning(spark):
    for parts in (1, 3, 8):
        got = sorted(tuple(r) for r in _stored_minutes(spark, parts).collect())
        assert got == _expected(), parts


def test_raw_rows_per_minute(spark):
    lines = read_landing(spark, os.path.join(FIXTURES, "landing"))
    from sensorlake.operators.parse import accepted, parse_lines
    from sensorlake.operators.rollup import minute_rollup
    from sensorlake.operators.slices import full_periods
    rows = full_periods(accepted(parse_lines(lines)), "minute")
    got = [r["raw_rows"] for r in minute_rollup(rows).orderBy("timestamp", "device_id").collect()]
    assert got == RAW_ROWS
    assert rows.count() == 160


def test_file_name_is_last_record(spark):
    lines = read_landing(spark, os.path.join(FIXTURES, "landing"))
    r = lines.select("file_time").distinct().collect()
    assert [x[0] for x in r] == [ts("2020-07-20 00:03:37.264313")]


def test_complete_hour_features(spark):
    minutes = _stored_minutes(spark, 3)
    stats = hourly_stats(minutes.where(F.col("timestamp") < F.lit("2020-07-20").cast("timestamp_ntz")))
    ml = {r["device_id"]: r for r in ml_mart(stats).collect()}
    cnt = {r["device_id"]: r["record_count"] for r in stats.collect()}
    exp = {
        "00:0f:00:70:91:0a": (0.00374090505, 2.7720713405e-11, 74.25, 3.125, 19.75, 0.405, (50, 50, 50)),
        "1c:bf:ce:15:ec:4d": (0.0045134048, 5.9835858048e-10, 75.9, 0.0, 26.65, 0.005, (50, 0, 50)),
        "b8:27:eb:bf:9d:51": (0.00584278575, 6.6282528708e-09, 49.5, 0.0, 22.65, 0.005, (50, 0, 50)),
    }
    for dev, (mco, vco, mh, vh, mt, vt, pct) in exp.items():
        r = ml[dev]
        assert cnt[dev] == 2
        for got, want in [(r["mean_co"], mco), (r["variance_co"], vco), (r["mean_humidity"], mh),
                          (r["variance_humidity"], vh), (r["mean_temperature"], mt),
                          (r["variance_temperature"], vt)]:
            assert math.isclose(got, want, rel_tol=1e-9, abs_tol=1e-12), (dev, got, want)
        assert (r["high_low_percentage_co"], r["high_low_percentage_humidity"],
                r["high_low_percentage_temperature"]) == pct
        assert all(r[f"{f}_change_last_hour"] is None for f in ["co", "humidity", "lpg", "smoke", "temperature"])


def test_count_mart_export_completeness(spark):
    from sensorlake.operators.quality import completeness
    df = (spark.read.option("header", True).schema("timestamp timestamp_ntz, device_id string, record_count int")
          .csv(os.path.join(FIXTURES, "dm_iot_count.csv")))
    assert df.count() == 576
    assert df.agg(F.sum("record_count")).first()[0] == 34557
    low = completeness(df).collect()
    assert len(low) == 3 and all(r["record_count"] == 59 for r in low)
    assert {r["timestamp"] for r in low} == {ts("2020-07-12 00:00:00")}

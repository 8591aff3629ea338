"""Incremental jobs on catalog tables: idempotence, late rows, empty input."""
import os
import shutil

from pyspark.sql import functions as F

from sensorlake.operators.marts import hourly_stats, ml_mart
from sensorlake.operators.quality import constraint_violations, duplicate_keys
from sensorlake.operators.store import append_new
from sensorlake.plans.jobs import run_hour, run_minute
from sensorlake.schemas import MART_NAMES, MINUTE_TABLE, MINUTE_TABLE_NAME
from sensorlake.sources.landing import read_landing, rejected_files
from sensorlake.sources.tables import Lakehouse

from conftest import FIXTURES
from helpers import line, minute_rows, ts

D = "b8:27:eb:bf:9d:51"


def _write(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_minute_job_is_idempotent_and_stored_row_wins(spark, scratch):
    lake = Lakehouse(spark, "t_minute")
    lake.drop_all()
    landing = os.path.join(scratch, "landing")
    shutil.copytree(os.path.join(FIXTURES, "landing"), landing)
    run_minute(spark, lake, landing, ingest_seq=1)
    first = lake.read(MINUTE_TABLE_NAME)
    assert first.count() == 15
    snap = sorted(tuple(r) for r in first.drop("ingest_seq").collect())
    # second run without new files: unchanged
    run_minute(spark, lake, landing, ingest_seq=2)
    assert sorted(tuple(r) for r in lake.read(MINUTE_TABLE_NAME).drop("ingest_seq").collect()) == snap
    # a later file with a late row for a stored minute and new complete minutes
    late = [line("2020-07-20 00:02:30.000000", D, co="0.009"),
            line("2020-07-20 00:03:10.000000", D), line("2020-07-20 00:04:10.000000", D),
            line("2020-07-20 00:05:10.000000", D)]
    _write(landing, "2020-07-20_00_05_10.000000.txt", late)
    run_minute(spark, lake, landing, clean=False, ingest_seq=3)
    after = lake.read(MINUTE_TABLE_NAME)
    assert duplicate_keys(after).count() == 0
    stored = after.where((F.col("timestamp") == F.lit("2020-07-20 00:02:00").cast("timestamp_ntz"))
                         & (F.col("device_id") == D)).collect()[0]
    assert stored["ingest_seq"] == 1  # the stored row won
    # the first file is re-read too (its name is later than the watermark): its
    # 00:03 minute, cut as incomplete before, is now complete for all 3 devices
    new = after.where(F.col("ingest_seq") == 3).select("timestamp", "device_id").collect()
    assert sorted((str(r[0]), r[1]) for r in new) == sorted(
        [("2020-07-20 00:03:00", d) for d in ("00:0f:00:70:91:0a", "1c:bf:ce:15:ec:4d", D)]
        + [("2020-07-20 00:04:00", D)])


def test_empty_landing_and_bad_file_names(spark, scratch):
    lake = Lakehouse(spark, "t_empty")
    lake.drop_all()
    landing = os.path.join(scratch, "landing")
    _write(landing, "not-a-timestamp.txt", [line("2020-07-20 00:02:30.000000", D)])
    run_minute(spark, lake, landing)
    assert lake.read(MINUTE_TABLE_NAME).count() == 0
    bad = rejected_files(read_landing(spark, landing)).collect()
    assert [r["file_name"] for r in bad] == ["not-a-timestamp.txt"]


def _minutes(spark, hours, devices=(D, "00:0f:00:70:91:0a")):
    rows = []
    for h in range(hours):
        for m in range(0, 60, 7):
            for i, d in enumerate(devices):
                if d != D and h == 2:
                    continue  # second device silent for an hour
                rows.append((f"2020-01-01 {h:02d}:{m:02d}:00", d, f"0.00{(h + m + i) % 9 + 1}",
                             f"{40 + (h * m) % 7}.{m % 10}", "0.006", "0.02", f"2{h % 10}.{i}", (h + m) % 2))
    return minute_rows(spark, rows)


def test_hourly_incremental_equals_full_recompute(spark):
    lake = Lakehouse(spark, "t_hour")
    lake.drop_all()
    lake.create_all()
    all_rows = _minutes(spark, 7)
    from sensorlake.operators.store import storage_cast, stored_rows, with_partition_columns
    stored = stored_rows(storage_cast(all_rows, MINUTE_TABLE))
    # load the first 4 hours (+ a partial 5th), run, then the rest, run again
    first = stored.where(F.col("timestamp") < F.lit("2020-01-01 04:30:00").cast("timestamp_ntz"))
    lake.append(MINUTE_TABLE_NAME, with_partition_columns(first, 1))
    run_hour(spark, lake, ingest_seq=1)
    rest = append_new(stored, lake.read(MINUTE_TABLE_NAME))
    lake.append(MINUTE_TABLE_NAME, with_partition_columns(rest, 2))
    run_hour(spark, lake, ingest_seq=2)
    run_hour(spark, lake, ingest_seq=3)  # nothing new: no change
    inc = {(r["timestamp"], r["device_id"]): r for r in lake.read("dm_iot_ml").collect()}
    full_stats = hourly_stats(lake.read(MINUTE_TABLE_NAME).where(
        F.col("timestamp") < F.lit("2020-01-01 06:00:00").cast("timestamp_ntz")))
    from sensorlake.operators.store import storage_cast as sc
    from sensorlake.schemas import mart_schema
    full = {(r["timestamp"], r["device_id"]): r
            for r in sc(ml_mart(full_stats), mart_schema("dm_iot_ml")).drop("reject").collect()}
    assert set(inc) == set(full) and len(full) == 11
    for k, r in full.items():
        for c in r.asDict():
            assert inc[k][c] == r[c], (k, c)
    for name in MART_NAMES:
        assert duplicate_keys(lake.read(name)).count() == 0


def test_change_spans_any_silence(spark):
    """A device that was silent for eleven days gets its change against its last stored hour."""
    from sensorlake.operators.store import storage_cast, stored_rows, with_partition_columns
    lake = Lakehouse(spark, "t_silent")
    lake.drop_all()
    lake.create_all()
    other = "00:0f:00:70:91:0a"
    rows = [(f"2020-01-{d:02d} {h:02d}:{m:02d}:00", other, f"0.00{d % 8 + 1}", "50.0", "0.006", "0.02", "20.0", 0)
            for d in range(1, 13) for h in (3, 9) for m in (0, 30)]
    rows += [(f"2020-01-01 05:{m:02d}:00", D, "0.001", "50.0", "0.006", "0.02", "20.0", 0) for m in (0, 10)]
    rows += [(f"2020-01-12 06:{m:02d}:00", D, "0.008", "50.0", "0.006", "0.02", "20.0", 0) for m in (0, 10)]
    rows += [("2020-01-12 10:00:00", other, "0.002", "50.0", "0.006", "0.02", "20.0", 0)]
    stored = stored_rows(storage_cast(minute_rows(spark, rows), MINUTE_TABLE))
    cut = F.lit("2020-01-12 04:00:00").cast("timestamp_ntz")
    for seq, part in enumerate((stored.where(F.col("timestamp") < cut), stored.where(F.col("timestamp") >= cut))):
        lake.append(MINUTE_TABLE_NAME, with_partition_columns(part, seq))
        run_hour(spark, lake, ingest_seq=seq)
    changes = {(str(r["timestamp"]), r["device_id"]): r["co_change_last_hour"] for r in lake.read("dm_iot_ml").collect()}
    assert float(changes["2020-01-12 06:00:00", D]) == 0.007
    assert changes["2020-01-01 05:00:00", D] is None and len(changes) == 26


def test_a_minute_without_any_value_is_a_reject(spark):
    from sensorlake.operators.store import storage_cast
    df = minute_rows(spark, [("2020-01-01 00:00:00", D, "1.0", "50.0", "0.006", "0.02", "20.0", 1)])
    assert storage_cast(df, MINUTE_TABLE).first()["reject"] is None
    assert storage_cast(df.withColumn("co", F.lit(None).cast("double")), MINUTE_TABLE).first()["reject"] == "null"


def test_constraint_report(spark):
    df = minute_rows(spark, [("2020-01-01 00:00:00", D + "xx", "1.0", "50.0", "0.006", "0.02", "20.0", 3)])
    df = df.withColumn("co", F.lit(123.0))
    got = {(r["column_name"], r["check_name"]): r["violations"]
           for r in constraint_violations(df, MINUTE_TABLE).collect()}
    assert got == {("device_id", "length"): 1, ("light", "domain"): 1, ("co", "range"): 1}


def test_table_ddl_probe_and_drop(spark):
    lake = Lakehouse(spark, "t_ddl")
    lake.drop_all()
    names = [MINUTE_TABLE_NAME, *MART_NAMES]
    assert not any(lake.exists(t) for t in names)
    lake.create_all()
    lake.create_all()  # idempotent
    assert all(lake.exists(t) for t in names)
    assert lake.latest_timestamp(MINUTE_TABLE_NAME) is None
    cols = lake.read("dm_iot_ml").columns
    assert len(cols) == 35 + 2 and cols[-2:] == ["ingest_seq", "dt"]
    lake.drop_all()
    assert not any(lake.exists(t) for t in names)


def _half_days(spark, name):
    from sensorlake.operators.store import storage_cast, stored_rows, with_partition_columns
    lake = Lakehouse(spark, name)
    lake.drop_all()
    lake.create_all()
    stored = stored_rows(storage_cast(_minutes(spark, 7), MINUTE_TABLE))
    early = F.col("timestamp") < F.lit("2020-01-01 04:30:00").cast("timestamp_ntz")
    for k, part in enumerate((stored.where(early), stored.where(~early))):
        yield lake, lambda part=part, k=k: lake.append(MINUTE_TABLE_NAME, with_partition_columns(part, k))


def test_readers_see_four_marts_of_one_state(spark, monkeypatch):
    """A failure between two marts leaves readers on the old state of all; the next run publishes everything."""
    (lake, first), (_, second) = _half_days(spark, "t_publish")
    assert lake.published_seq() is None and lake.read_published("dm_iot_ml").count() == 0
    first()
    run_hour(spark, lake, ingest_seq=10)
    seen = lambda: [lake.read_published(t).count() for t in MART_NAMES]
    before = seen()
    assert before[0] > 0 and len(set(before)) == 1
    second()
    append = Lakehouse.append

    def broken(self, table, rows):
        if table == MART_NAMES[2]:
            raise OSError("lost")
        append(self, table, rows)

    monkeypatch.setattr(Lakehouse, "append", broken)
    try:
        run_hour(spark, lake, ingest_seq=11)
    except OSError:
        pass
    else:
        raise AssertionError("the append should have failed")
    monkeypatch.undo()
    assert lake.read(MART_NAMES[0]).count() > before[0] and seen() == before
    run_hour(spark, lake, ingest_seq=12)
    assert lake.published_seq() == 12 and seen() == [lake.read(t).count() for t in MART_NAMES] and seen()[0] > before[0]
    assert all(duplicate_keys(lake.read_published(t)).count() == 0 for t in MART_NAMES)
    try:
        run_hour(spark, lake, ingest_seq=5)
    except ValueError:
        pass
    else:
        raise AssertionError("an older load number should be refused")


def test_compaction_bounds_the_files_of_a_day(spark):
    from sensorlake.operators.store import storage_cast, stored_rows, with_partition_columns
    lake = Lakehouse(spark, "t_compact")
    lake.drop_all()
    lake.create_all()
    stored = stored_rows(storage_cast(_minutes(spark, 7), MINUTE_TABLE))
    for k in range(4):
        lake.append(MINUTE_TABLE_NAME, with_partition_columns(stored.where(F.pmod(F.hour("timestamp"), F.lit(4)) == k).repartition(3), k))
    other = stored.limit(5).withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 3 DAYS"))
    lake.append(MINUTE_TABLE_NAME, with_partition_columns(other.coalesce(1), 9))
    rows = lambda: sorted(tuple(r) for r in lake.read(MINUTE_TABLE_NAME).collect())
    before = rows()
    files = {str(r["dt"]): r["files"] for r in lake.files(MINUTE_TABLE_NAME).collect()}
    assert files["2020-01-01"] > 8 and files["2020-01-04"] == 1
    assert lake.compact(MINUTE_TABLE_NAME, most_files=2, rows_per_file=60) == 1
    assert rows() == before
    after = {str(r["dt"]): (r["files"], r["rows"]) for r in lake.files(MINUTE_TABLE_NAME).collect()}
    assert after["2020-01-01"][0] <= 2 and after["2020-01-04"] == (1, 5)
    assert lake.compact(MINUTE_TABLE_NAME, most_files=2) == 0


def test_bucketed_tables_are_joined_where_they_lie(spark):
    """Same rows as without buckets, no exchange of the stored side, and a file for each bucket after compaction."""
    from sensorlake.operators.store import storage_cast, stored_rows, with_partition_columns
    plain, lake = Lakehouse(spark, "t_plain"), Lakehouse(spark, "t_buckets", buckets=3)
    stored = stored_rows(storage_cast(_minutes(spark, 7), MINUTE_TABLE)).persist()
    for one in (plain, lake):
        one.drop_all()
        one.create_all()
        for k in range(3):
            one.append(MINUTE_TABLE_NAME, with_partition_columns(append_new(stored.where(F.hour("timestamp") <= 2 * k + 2), one.read(MINUTE_TABLE_NAME)), k))
        run_hour(spark, one, ingest_seq=1)
    rows = lambda x, t: sorted(tuple(r) for r in x.read(t).drop("ingest_seq").collect())
    for t in [MINUTE_TABLE_NAME, *MART_NAMES]:
        assert rows(plain, t) == rows(lake, t) and rows(lake, t)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = append_new(stored, lake.read(MINUTE_TABLE_NAME))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert plan.index("Exchange hashpartitioning") < plan.index("FileScan parquet")  # of the new rows, the left side
    day = lambda: {r["files"] for r in lake.files(MINUTE_TABLE_NAME).collect()}
    assert max(day()) > 3
    kept = rows(lake, MINUTE_TABLE_NAME)
    assert lake.compact(MINUTE_TABLE_NAME, most_files=3) == 1 and max(day()) <= 3 and rows(lake, MINUTE_TABLE_NAME) == kept

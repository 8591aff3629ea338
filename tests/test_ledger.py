"""File ledger, and landing batches whose last line is faulty."""
import os

from pyspark.sql import functions as F

from sensorlake.plans.jobs import run_minute
from sensorlake.schemas import FILE_LEDGER_NAME, MINUTE_TABLE_NAME
from sensorlake.sources.landing import batch_labels, list_landing, read_landing, write_landing
from sensorlake.sources.ledger import line_account
from sensorlake.sources.tables import Lakehouse

from helpers import line, ts

D = "b8:27:eb:bf:9d:51"
KEY = ["timestamp", "device_id", "co", "humidity", "lpg", "smoke", "temperature", "light"]


def _fresh(spark, name):
    lake = Lakehouse(spark, name)
    lake.drop_all()
    return lake


def _indexed(spark, lines, first=1):
    return spark.createDataFrame([(first + i, v) for i, v in enumerate(lines)], "row_idx long, value string")


def _minutes(lake):
    return sorted(tuple(r) for r in lake.read(MINUTE_TABLE_NAME).select(*KEY).collect())


def _ledger(lake):
    return {(r["status"], str(r["file_time"])): r for r in lake.read(FILE_LEDGER_NAME).collect()}


def test_batches_that_end_in_a_faulty_line_are_loaded(spark, scratch):
    """Three loads store what one load over the same files stores, minutes of the faulty batch included."""
    parts = [[line(f"2020-07-20 00:{m:02d}:{s:02d}.000000", D) for m in range(k * 4, k * 4 + 4) for s in (5, 40)] for k in range(3)]
    parts[1].append("2020-99-20 00:07:50.000000 broken line at the end")
    parts[2].append(line("2020-07-20 00:12:00.000000", D))
    loads, once = _fresh(spark, "t_ledger3"), _fresh(spark, "t_ledger1")
    landing = os.path.join(scratch, "landing")
    first = 1
    for k, part in enumerate(parts):
        write_landing(_indexed(spark, part, first), landing, batch_size=100)
        first += len(part)
        result = run_minute(spark, loads, landing, clean=False, ingest_seq=k)
        assert result["refused_files"].count() == result["late_files"].count() == 0
    run_minute(spark, once, landing, clean=False)
    assert _minutes(loads) == _minutes(once) and len(_minutes(loads)) == 12
    rows = _ledger(loads)
    assert sorted((r["ingest_seq"], str(r["file_time"]), r["lines"], r["rejected_lines"]) for r in rows.values()) == [
        (0, "2020-07-20 00:03:40", 8, 0), (1, "2020-07-20 00:07:40", 9, 1), (2, "2020-07-20 00:12:00", 9, 0)]


def test_late_and_refused_files_are_named_and_not_read(spark, scratch):
    lake, landing = _fresh(spark, "t_ledgerlate"), os.path.join(scratch, "landing")
    os.makedirs(landing)

    def put(name, lines):
        with open(os.path.join(landing, name), "w") as fh:
            fh.write("".join(x + "\n" for x in lines))

    put("2020-07-20_00_05_00.000000.txt", [line(f"2020-07-20 00:{m:02d}:00.000000", D) for m in range(6)])
    put("no-time.txt", [line("2020-07-20 00:01:30.000000", D, co="9.0"), line("2020-07-20 00:30:00.000000", D)])
    first = run_minute(spark, lake, landing, clean=False, ingest_seq=1)
    assert [r["file_name"] for r in first["refused_files"].collect()] == ["no-time.txt"]
    assert len(_minutes(lake)) == 5 and max(float(r[2]) for r in _minutes(lake)) < 1  # the refused file is no data, in the first run too
    put("2020-07-20_00_02_00.000000.txt", [line("2020-07-20 00:02:00.000000", "1c:bf:ce:15:ec:4d")])
    put("2020-07-20_00_07_00.000000.txt", [line("2020-07-20 00:03:10.000000", D), "rubbish", line("2020-07-20 00:07:00.000000", D)])
    second = run_minute(spark, lake, landing, clean=False, ingest_seq=2)
    assert [(r["file_name"], r["lines"]) for r in second["late_files"].collect()] == [("2020-07-20_00_02_00.000000.txt", None)]
    assert second["refused_files"].count() == 0  # named once
    rows = _ledger(lake)
    loaded = rows["loaded", "2020-07-20 00:07:00"]
    assert (loaded["lines"], loaded["rejected_lines"], loaded["late_lines"], loaded["watermark"]) == (3, 1, 1, ts("2020-07-20 00:04:00"))
    assert rows["refused", "None"]["bytes"] > 0 and len(rows) == 4
    third = run_minute(spark, lake, landing, clean=False, ingest_seq=3)
    assert third["files"].count() == 0 and lake.read(FILE_LEDGER_NAME).count() == 4


def test_a_load_that_fails_after_its_ledger_rows_is_repeated(spark, scratch, monkeypatch):
    lake, landing = _fresh(spark, "t_ledgerfail"), os.path.join(scratch, "landing")
    write_landing(_indexed(spark, [line(f"2020-07-20 00:{m:02d}:00.000000", D) for m in range(4)]), landing)
    append, calls = Lakehouse.append, []

    def broken(self, table, rows):
        if table == MINUTE_TABLE_NAME and not calls:
            calls.append(table)
            raise OSError("lost")
        append(self, table, rows)

    monkeypatch.setattr(Lakehouse, "append", broken)
    try:
        run_minute(spark, lake, landing, clean=False, ingest_seq=1)
    except OSError:
        pass
    run_minute(spark, lake, landing, clean=False, ingest_seq=2)
    assert calls and len(_minutes(lake)) == 3
    assert [(r["status"], r["ingest_seq"]) for r in lake.read(FILE_LEDGER_NAME).collect()] == [("loaded", 1)]


def test_days_before_the_horizon_are_not_listed(spark, scratch):
    landing = os.path.join(scratch, "landing")
    for day in (1, 5, 9):
        write_landing(_indexed(spark, [line(f"2020-07-0{day} 00:00:00.000000", D)]), landing)
    assert list_landing(spark, landing).count() == 3
    since = list_landing(spark, landing, ts("2020-07-05 12:00:00"))
    assert sorted(str(r["file_time"]) for r in since.collect()) == ["2020-07-05 00:00:00", "2020-07-09 00:00:00"]
    lake = _fresh(spark, "t_ledgerdays")
    run_minute(spark, lake, landing, clean=False, ingest_seq=1)
    write_landing(_indexed(spark, [line("2020-07-02 00:00:00.000000", D)]), landing)
    assert run_minute(spark, lake, landing, clean=False, ingest_seq=2, ledger_days=1)["files"].count() == 0
    assert run_minute(spark, lake, landing, clean=False, ingest_seq=3, ledger_days=30)["late_files"].count() == 1


def test_batches_without_any_valid_timestamp(spark, scratch):
    landing = os.path.join(scratch, "landing")
    rows = _indexed(spark, ["", "x", "2020-13-01 00:00:00 a", line("2020-07-01 00:00:00", D), "2020-07-01 00:00:01+05:00 b", "end"])
    assert [(r["batch_no"], r["batch"]) for r in batch_labels(rows, ["row_idx"], batch_size=3).orderBy("batch_no").collect()] == [
        (0, None), (1, "2020-07-01_00:00:00")]
    write_landing(rows, landing, batch_size=3)
    lake = _fresh(spark, "t_ledgernone")
    result = run_minute(spark, lake, landing, clean=False)
    assert sorted((r["status"], r["lines"]) for r in result["files"].collect()) == [("loaded", 3), ("refused", None)]
    assert "batch=none-0" in result["refused_files"].first()["file_path"]
    account = line_account(read_landing(spark, landing).where(F.col("file_time").isNotNull()), None).first()
    assert (account["lines"], account["rejected_lines"], account["late_lines"]) == (3, 2, 0)

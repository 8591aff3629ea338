"""Structured Streaming: stream = batch on the golden file; idempotent sink."""
import os
import shutil

import pytest
from pyspark.sql import functions as F

from sensorlake.operators.parse import accepted, parse_lines
from sensorlake.operators.quality import duplicate_keys
from sensorlake.operators.rollup import minute_rollup
from sensorlake.operators.slices import full_periods
from sensorlake.plans.jobs import run_minute
from sensorlake.schemas import MINUTE_TABLE_NAME
from sensorlake.sources.landing import read_landing
from sensorlake.sources.tables import Lakehouse
from sensorlake.streaming.streams import landing_stream, minute_stream, minute_table_sink, run_to_parquet

from conftest import FIXTURES
from helpers import line


def test_minute_stream_equals_batch(spark):
    src = landing_stream(spark, os.path.join(FIXTURES, "landing"))
    streamed = run_to_parquet(minute_stream(src).drop("window"), spark, "t-minute")
    batch = minute_rollup(full_periods(accepted(parse_lines(read_landing(spark, os.path.join(FIXTURES, "landing")))),
                                       "minute"))
    cols = ["timestamp", "device_id", "light", "raw_rows"]
    assert streamed.count() == 15
    assert sorted(tuple(r) for r in streamed.select(*cols).collect()) == \
        sorted(tuple(r) for r in batch.select(*cols).collect())


def test_foreach_batch_sink_matches_batch_job_and_is_idempotent(spark, scratch):
    landing = os.path.join(scratch, "landing")
    shutil.copytree(os.path.join(FIXTURES, "landing"), landing)
    lake_s, lake_b = Lakehouse(spark, "t_stream"), Lakehouse(spark, "t_streamb")
    lake_s.drop_all()
    lake_b.drop_all()
    ckpt, pending = os.path.join(scratch, "ckpt"), os.path.join(scratch, "pending")
    minute_table_sink(spark, lake_s, landing, pending, ckpt).awaitTermination()
    run_minute(spark, lake_b, landing)
    key = ["timestamp", "device_id", "co", "humidity", "lpg", "smoke", "temperature", "light"]
    got = sorted(tuple(r) for r in lake_s.read(MINUTE_TABLE_NAME).select(*key).collect())
    want = sorted(tuple(r) for r in lake_b.read(MINUTE_TABLE_NAME).select(*key).collect())
    assert got == want and len(got) == 15
    # restart on the same checkpoint with no new files: nothing is appended twice
    minute_table_sink(spark, lake_s, landing, pending, ckpt).awaitTermination()
    assert lake_s.read(MINUTE_TABLE_NAME).count() == 15
    assert os.path.isdir(os.path.join(pending, "batch=0"))
    pend = spark.read.parquet(os.path.join(pending, "batch=0"))
    # what follows the newest stored minute is carried over, as the batch job reads its file again
    assert pend.agg(F.min("timestamp")).first()[0].strftime("%H:%M") == "00:02"


def _stage(landing, name, lines):
    with open(os.path.join(landing, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_three_micro_batches_equal_three_batch_runs(spark, scratch):
    """Carry-over, a late row and an unfinished minute, cleaned; the stored tables agree and hold no key twice."""
    devices = ("b8:27:eb:bf:9d:51", "00:0f:00:70:91:0a")
    files = [[line(f"2020-07-20 00:{m:02d}:{s:02d}.000000", d, co=f"0.00{(m * 7 + s) % 9 + 1}", hum=f"{40 + (m * s) % 13}.0")
              for m in range(k * 4, k * 4 + 5) for s in ((10, 30, 50) if m < k * 4 + 4 else (5,)) for d in devices] for k in range(3)]
    files[1].insert(0, line("2020-07-20 00:00:20.000000", devices[0], co="9.0"))          # late: its minute is stored
    files[2].insert(0, line("2020-07-20 00:01:20.000000", "1c:bf:ce:15:ec:4d", co="9.0"))  # late, of a device not seen before
    stream_dir, batch_dir = os.path.join(scratch, "s"), os.path.join(scratch, "b")
    os.makedirs(stream_dir)
    os.makedirs(batch_dir)
    lake_s, lake_b = Lakehouse(spark, "t_stream3"), Lakehouse(spark, "t_batch3")
    lake_s.drop_all()
    lake_b.drop_all()
    ckpt, pending = os.path.join(scratch, "ckpt"), os.path.join(scratch, "pending")
    for k, content in enumerate(files):
        name = f"2020-07-20_00_{k * 4 + 4:02d}_05.000000.txt"
        _stage(stream_dir, name, content)
        _stage(batch_dir, name, content)
        minute_table_sink(spark, lake_s, stream_dir, pending, ckpt, max_files_per_trigger=1).awaitTermination()
        run_minute(spark, lake_b, batch_dir)
        key = ["timestamp", "device_id", "co", "humidity", "lpg", "smoke", "temperature", "light"]
        got = sorted(tuple(r) for r in lake_s.read(MINUTE_TABLE_NAME).select(*key).collect())
        want = sorted(tuple(r) for r in lake_b.read(MINUTE_TABLE_NAME).select(*key).collect())
        assert got == want and len(got) == 8 * (k + 1)
    assert duplicate_keys(lake_s.read(MINUTE_TABLE_NAME)).count() == 0
    assert sorted(f for f in os.listdir(pending) if f.startswith("batch")) == ["batch=1", "batch=2"]
    assert {r["device_id"] for r in lake_s.read(MINUTE_TABLE_NAME).collect()} == set(devices)


def test_a_lost_pending_folder_fails_the_batch(spark, scratch):
    landing, pending = os.path.join(scratch, "l"), os.path.join(scratch, "p")
    os.makedirs(landing)
    lake, ckpt = Lakehouse(spark, "t_lost"), os.path.join(scratch, "c")
    lake.drop_all()
    _stage(landing, "2020-07-20_00_01_05.000000.txt", [line("2020-07-20 00:00:10.000000", "a"), line("2020-07-20 00:01:05.000000", "a")])
    minute_table_sink(spark, lake, landing, pending, ckpt).awaitTermination()
    shutil.rmtree(pending)
    _stage(landing, "2020-07-20_00_02_05.000000.txt", [line("2020-07-20 00:02:05.000000", "a")])
    with pytest.raises(Exception):
        minute_table_sink(spark, lake, landing, pending, ckpt).awaitTermination()


def test_late_rows_are_counted_per_micro_batch(spark, scratch):
    from sensorlake.streaming.streams import late_row_counts
    devices = ("b8:27:eb:bf:9d:51", "00:0f:00:70:91:0a")
    landing, ckpt, pending, late = (os.path.join(scratch, k) for k in ("in", "ckpt", "pending", "late"))
    os.makedirs(landing)
    lake = Lakehouse(spark, "t_late")
    lake.drop_all()
    files = [[line(f"2020-07-20 00:{m:02d}:10.000000", d) for m in range(k * 3, k * 3 + 4) for d in devices] for k in range(3)]
    files[1] += [line("2020-07-20 00:01:30.000000", devices[0]), line("2020-07-20 00:00:30.000000", devices[0])]
    files[2] += [line("2020-07-20 00:04:00.000000", devices[1]), "faulty"]
    for k, content in enumerate(files):
        _stage(landing, f"2020-07-20_00_{k * 3 + 3:02d}_10.000000.txt", content)
        minute_table_sink(spark, lake, landing, pending, ckpt, clean=False, late_path=late).awaitTermination()
    got = sorted(tuple(r) for r in late_row_counts(spark, late).collect())
    assert got == [(1, devices[0], 2), (2, devices[1], 1)]


def test_a_micro_batch_is_parsed_once(spark, scratch, monkeypatch):
    """The late rows are counted on the pinned rows, not on the lines once more."""
    from sensorlake.operators import quality
    plans, late = [], quality.late_rows

    def spy(rows, watermark, *args):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return late(rows, watermark, *args)

    monkeypatch.setattr(quality, "late_rows", spy)
    lake = Lakehouse(spark, "t_parse_once")
    lake.drop_all()
    paths = [os.path.join(scratch, k) for k in ("pending", "ckpt", "late")]
    minute_table_sink(spark, lake, os.path.join(FIXTURES, "landing"), *paths[:2], clean=False, late_path=paths[2]).awaitTermination()
    assert plans and not any("split(" in p for p in plans), plans

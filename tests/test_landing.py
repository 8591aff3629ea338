"""Landing writer (SK1/SK2), historical replay (PL4) and the streaming landing sink (SS7)."""
import glob
import os

from pyspark.sql import functions as F

from sensorlake.plans.jobs import load_history
from sensorlake.sources.landing import read_landing, write_landing
from sensorlake.streaming.streams import landing_sink, landing_stream


def _history_csv(path, n):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "history.csv"), "w") as fh:
        # column order differs from the schema on purpose: read by header name
        fh.write("device,ts,co,humidity,light,lpg,motion,smoke,temp\n")
        for i in range(n):
            dev = ["b8:27:eb:bf:9d:51", "00:0f:00:70:91:0a", "1c:bf:ce:15:ec:4d"][i % 3]
            fh.write(f"{dev},{1594512000.0 + i * 1.5:.6f},{0.004 + i * 1e-7:.10f},51.0,{'true' if i % 2 else 'false'},"
                     f"0.0076,false,0.0204,{22 + i % 5 / 10:.1f}\n")


def _line_counts(path):
    counts = {}
    for f in glob.glob(os.path.join(path, "**", "*.txt"), recursive=True):
        with open(f) as fh:
            counts[f] = sum(1 for _ in fh)
    return counts


def test_history_replay_writes_labelled_batches(spark, scratch):
    src, landing = os.path.join(scratch, "hist"), os.path.join(scratch, "landing")
    _history_csv(src, 2500)
    load_history(spark, os.path.join(src, "history.csv"), landing)
    counts = _line_counts(landing)
    assert sorted(counts.values()) == [500, 1000, 1000]
    lines = read_landing(spark, landing)
    assert lines.count() == 2500
    # every file's label is its last (latest) record
    from sensorlake.operators.parse import accepted, parse_lines
    rows = accepted(parse_lines(lines, keep=["file_time", "file_path"]))
    chk = rows.groupBy("file_path", "file_time").agg(F.max("timestamp").alias("last")).collect()
    assert len(chk) == 3 and all(r["file_time"] == r["last"] for r in chk)
    first = rows.orderBy("timestamp").first()
    assert str(first["timestamp"]) == "2020-07-12 00:00:00" and first["light"] == 0


def test_streaming_landing_sink_bounds_files(spark, scratch):
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as fh:
        fh.write("\n".join(f"line {i}" for i in range(2300)) + "\n")
    q = landing_sink(landing_stream(spark, src), out, os.path.join(scratch, "ckpt"), records_per_file=1000)
    q.awaitTermination()
    counts = [n for f, n in _line_counts(out).items()]
    assert sum(counts) == 2300 and max(counts) <= 1000


def _stream_part(spark, src, name, lines):
    os.makedirs(src, exist_ok=True)
    with open(os.path.join(src, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_batches_fill_up_across_micro_batches(spark, scratch):
    """2,500 lines in five micro-batches: files of 1000, 1000 and 500 lines, labelled by their last lines."""
    from sensorlake.sources.landing import landing_files
    from sensorlake.streaming.streams import close_landing_batches, landing_batch_sink
    src, out, pending, ckpt = (os.path.join(scratch, k) for k in ("in", "out", "pending", "ckpt"))
    lines = [f"2020-07-12 {i // 3600:02d}:{i // 60 % 60:02d}:{i % 60:02d}.000000 dev {i}" for i in range(2500)]
    lines[1499] = "a faulty line"
    written = []
    for k in range(5):
        _stream_part(spark, src, f"{k}.txt", lines[k * 500:(k + 1) * 500])
        landing_batch_sink(landing_stream(spark, src), out, pending, ckpt).awaitTermination()
        written.append(sorted(_line_counts(out).values()))
    assert written == [[], [1000], [1000], [1000, 1000], [1000, 1000]]
    close_landing_batches(spark, out, pending)
    assert sorted(_line_counts(out).values()) == [500, 1000, 1000]
    close_landing_batches(spark, out, pending)  # closing again replaces the same file
    rows = read_landing(spark, out)
    got = sorted((str(r["file_time"]), r["lines"]) for r in landing_files(rows).collect())
    assert got == [("2020-07-12 00:16:39", 1000), ("2020-07-12 00:33:19", 1000), ("2020-07-12 00:41:39", 500)]
    assert sorted(r["value"] for r in rows.select("value").collect()) == sorted(lines)


def test_a_replayed_micro_batch_writes_nothing_twice(spark, scratch):
    from sensorlake.streaming.streams import landing_batch_sink
    src, out, pending, ckpt = (os.path.join(scratch, k) for k in ("in", "out", "pending", "ckpt"))
    lines = [f"2020-07-12 00:{i // 60:02d}:{i % 60:02d}.000000 dev {i}" for i in range(250)]
    for k in range(2):
        _stream_part(spark, src, f"{k}.txt", lines[k * 125:(k + 1) * 125])
        landing_batch_sink(landing_stream(spark, src), out, pending, ckpt, records_per_file=100).awaitTermination()
    for f in ("1", ".1.crc"):  # as if the driver had died before the second commit
        os.remove(os.path.join(ckpt, "commits", f))
    landing_batch_sink(landing_stream(spark, src), out, pending, ckpt, records_per_file=100).awaitTermination()
    got = [r["value"] for r in read_landing(spark, out).select("value").collect()]
    assert sorted(got) == lines[:200] and sorted(_line_counts(out).values()) == [100, 100]


def test_short_batches_are_written_by_many_tasks(spark, scratch):
    """The time of a write goes into its files, however few bytes they hold."""
    path = os.path.join(scratch, "short")
    rows = spark.range(1, 41).select((F.col("id") * 10).alias("row_idx"), F.concat(F.date_format(F.timestamp_seconds(F.col("id") + 1595116800), "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(" d 1 2 3 4 5 1")).alias("value"))
    write_landing(rows, path, batch_size=10)
    files = [f for _, _, names in os.walk(path) for f in names if f.startswith("part-")]
    assert len(files) == 40 and len({f.split("-")[1] for f in files}) > 1


def test_file_time_of_odd_paths(spark):
    """Only texts that can be a label are tried, and the path is cut without a regular expression."""
    from sensorlake.sources.landing import _file_time
    good, at = "2020-07-20_00_03_37.264313", "2020-07-20 00:03:37.264313"
    cases = {f"file:/a/{good}.txt": at, "file:/a/2020-07-20_00:03:37.264313.txt": at, f"file:/a/day=2020-07-20/batch={good}/part-00000-x.c000.txt": at,
             f"file:/a/xbatch={good}/part-0.txt": at, f"file:/batch={good}/b/part-0.txt": None, "file:/a/batch=/part-0.txt": None, "file:/a/batch=none-3/part-0.txt": None,
             "file:/a/2020-99-20_00_03_37.264313.txt": None, "file:/a/-.txt": None, "file:/a/x y.txt": None, f"file:/a/{good}/b.txt": None}
    out = spark.createDataFrame([(p,) for p in cases], "file_path string").select("file_path", _file_time().alias("t"))
    assert {r["file_path"]: r["t"] and str(r["t"]) for r in out.collect()} == cases
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract" not in plan and "RLIKE" in plan.upper()

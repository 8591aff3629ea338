"""Distributed row index, clipping and interpolation vs a pandas computation."""
import re

import numpy as np
import pytest
import pandas as pd
from pyspark.sql import functions as F

from sensorlake.operators.clean import batch_quantiles, clip_outliers, interpolate, row_index


def _frame(spark, values, devices=None):
    n = len(values)
    devices = devices or ["d"] * n
    rows = [(i, devices[i], None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "t long, device_id string, x double")


def _fill(spark, values, parts, devices=None, group=None):
    df = _frame(spark, values, devices)
    out = interpolate(df, ["t"], ["x"], group_cols=group, num_partitions=parts).orderBy("t")
    return [r["x"] for r in out.collect()]




def test_leading_inner_trailing_gaps(spark):
    assert _fill(spark, [None, 1], 2) == [None, 1.0]
    assert _fill(spark, [1, None, None, 4], 3) == [1.0, 2.0, 3.0, 4.0]
    assert _fill(spark, [4, None], 2) == [4.0, 4.0]


def test_matches_pandas_on_any_partitioning(spark):
    rng = np.random.default_rng(7)
    vals = rng.normal(size=300)
    vals[rng.random(300) < 0.6] = np.nan
    vals[100:150] = np.nan
    vals[:3] = np.nan
    vals[-4:] = np.nan
    want = pd.Series(vals).interpolate(method="linear").tolist()
    values = [None if np.isnan(v) else v for v in vals]
    for parts in (1, 7, 9):
        got = _fill(spark, values, parts)
        for g, w in zip(got, want):
            assert (g is None and np.isnan(w)) or abs(g - w) <= 1e-12 * max(1, abs(w)), parts


def test_per_device_fill_does_not_cross_devices(spark):
    values = [1, None, 3, None, 10, None]
    devices = ["a", "a", "a", "a", "b", "b"]
    got = _fill(spark, values, 3, devices, ["device_id"])
    assert got == [1.0, 2.0, 3.0, 3.0, 10.0, 10.0]


def test_row_index_dense_and_ordered(spark):
    df = spark.range(0, 1000).withColumn("k", (F.col("id") * 7919) % 1000)
    idx = row_index(df, ["k"], num_partitions=6).orderBy("k").collect()
    assert [r["row_idx"] for r in idx] == list(range(1, 1001))


def test_hot_timestamp_is_split(spark):
    # one timestamp holding most rows: ties are broken by the extra keys
    df = spark.range(0, 2000).select((F.col("id") % 2 * 0 + F.when(F.col("id") < 1500, 5).otherwise(F.col("id"))).alias("t"),
                                     F.col("id").alias("tie"))
    idx = row_index(df, ["t", "tie"], num_partitions=8)
    assert idx.select("row_idx").distinct().count() == 2000
    parts = idx.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in parts) < 1500


def test_quantiles_and_clip(spark):
    vals = list(range(101))
    df = _frame(spark, vals)
    lim = batch_quantiles(df, ["x"], (0.01, 0.99)).collect()[0]
    assert (lim["x_lo"], lim["x_hi"]) == (1.0, 99.0)
    clipped = clip_outliers(df, batch_quantiles(df, ["x"]), ["x"]).orderBy("t").collect()
    assert clipped[0]["x"] is None and clipped[100]["x"] is None and clipped[50]["x"] == 50.0


def test_quantiles_equal_percentile(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), ["a", "b", "c"][i % 3], float(v) if i % 11 else None, float(round(w, 1)))
            for i, (v, w) in enumerate(zip(rng.normal(size=500), rng.normal(size=500) * 10))]
    df = spark.createDataFrame(rows, "t long, device_id string, x double, y double")
    for group in (None, ["device_id"]):
        a = batch_quantiles(df, ["x", "y"], (0.01, 0.5, 0.99), group_cols=group)
        key = group or []
        b = df.groupBy(*key).agg(*[F.percentile(f, F.lit(p)).alias(f"{f}_{i}")
                                   for f in ("x", "y") for i, p in enumerate((0.01, 0.5, 0.99))])
        ra = sorted(tuple(r) for r in a.select(*b.columns).collect())
        rb = sorted(tuple(r) for r in b.collect())
        assert len(ra) == len(rb)
        for u, v in zip(ra, rb):
            for p, q in zip(u, v):
                assert p == q or abs(p - q) <= 1e-12 * max(1.0, abs(q)), (group, u, v)


def test_quantiles_skip_nan_and_null(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(float("nan"),), (None,)], "x double")
    for exact in (True, False):
        r = batch_quantiles(df, ["x"], (0.01, 0.99), exact=exact).first()
        assert (r["x_lo"], r["x_hi"]) == (1.0, 99.0)
    nothing = batch_quantiles(df.where("x is null"), ["x"]).collect()
    assert [r.asDict() for r in nothing] in ([], [{"x_lo": None, "x_hi": None}])


def test_quantiles_of_a_hot_value_use_no_large_task(spark):
    """90 % of the rows share one value: nothing is sorted but the values of a bracket, each once with its count."""
    from sensorlake.operators import clean
    df = spark.range(50_000).select(F.when(F.col("id") % 10 != 0, F.lit(5.0)).otherwise(F.col("id") / 10).alias("x"))
    sorted_, ranked = [], []
    sequence, picked = clean.sequence, clean._picked

    def spy(frame, cells, ps, keys):
        ends = [F.col("x").between(lo, hi) for _, _, _, lo, hi in cells]
        ranked.extend(frame.where(e).select("x").distinct().count() for e in ends)
        return picked(frame, cells, ps, keys)

    clean.sequence, clean._picked = lambda *a, **k: sorted_.append(a), spy
    try:
        r = clean.batch_quantiles(df, ["x"], (0.01, 0.5, 0.999)).first()
    finally:
        clean.sequence, clean._picked = sequence, picked
    want = df.agg(*[F.percentile("x", F.lit(p)).alias(str(p)) for p in (0.01, 0.5, 0.999)]).first()
    assert [r[f"x_{i}"] for i in range(3)] == pytest.approx(list(want))
    assert not sorted_ and len(ranked) == 3 and max(ranked) < 50


@pytest.mark.parametrize("n", [0, 1, 7, 3000])
@pytest.mark.parametrize("misses", [False, True])
def test_bracketed_quantiles_are_exact(spark, monkeypatch, n, misses):
    """Ties, missing values and features without any; also when no bracket holds its ranks."""
    from sensorlake.operators import clean as C
    if misses:
        monkeypatch.setattr(C, "BRACKET", -1)  # ends on the wrong sides
        monkeypatch.setattr(C, "SKETCH", 1000)
    rng = np.random.default_rng(n)
    rows = [(f"d{i % 3}", float(rng.normal()), float(round(rng.normal(), 1)), None if i % 5 == 0 else float(i % 3), None, float("nan") if i % 2 else 1.5)
            for i in range(n)]
    df = spark.createDataFrame(rows, "g string, a double, b double, c double, z double, w double").repartition(3)
    probs = (0.01, 0.99)

    def expected(own):
        out = {}
        for k, f in enumerate("abczw"):
            v = [r[k + 1] for r in own if r[k + 1] is not None and r[k + 1] == r[k + 1]]
            out |= {f"{f}_{name}": float(np.quantile(v, p)) if v else None for name, p in zip(("lo", "hi"), probs, strict=True)}
        return out

    def same(got, want):
        assert got.keys() == want.keys()
        for c, x in want.items():
            assert (got[c] is None) == (x is None) and (x is None or abs(got[c] - x) < 1e-12), c

    same(C.batch_quantiles(df, list("abczw"), probs).collect()[0].asDict(), expected(rows))
    groups = {r["g"]: r.asDict() for r in C.batch_quantiles(df, list("abczw"), probs, group_cols=["g"]).collect()}
    assert set(groups) == {r[0] for r in rows}
    for g, got in groups.items():
        got.pop("g")
        same(got, expected([r for r in rows if r[0] == g]))


@pytest.mark.parametrize("few", [10_000, 0])
def test_rows_of_one_device_stay_spread_over_tasks(spark, monkeypatch, few):
    """Quantiles, clip and fill per device: no task gets all rows of a device, by broadcast or by segment."""
    from sensorlake.operators import clean as C
    monkeypatch.setattr(C, "FEW_GROUPS", few)
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(4000).select(F.col("id").alias("timestamp"), F.when(F.col("id") % 8 == 0, "b").otherwise("a").alias("device_id"),
                                      F.col("id").cast("double").alias("x"))
        out = C.clean_batch(df, ["timestamp"], ["x"], ["device_id"], num_partitions=16)
        rows, plan = out.collect(), out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    dealt = re.search(r"Window .*?hashpartitioning\((.*?)\)", plan, re.DOTALL).group(1)
    assert len(rows) == 4000 and "_pid" in dealt, dealt
    got = pd.DataFrame(rows, columns=out.columns).sort_values("timestamp")
    for device, own in got.groupby("device_id"):
        x = pd.Series([float(i) for i in range(4000) if (i % 8 == 0) == (device == "b")])
        kept = x.where((x >= np.quantile(x, 0.01)) & (x <= np.quantile(x, 0.99)))
        np.testing.assert_allclose(own["x"].to_numpy(float), kept.interpolate(method="linear").to_numpy())

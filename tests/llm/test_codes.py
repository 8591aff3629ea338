"""Product codes against plain Python; the bounds never change a result and spare scans."""
import math
import random

import brute
import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from sensorlake.llm import codes as C
from sensorlake.llm import registry


def table(spark, rows, parts=3):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(parts)


def usable(rows, length):
    return [(i, v, x) for i, v, x in rows if v is not None and len(v) == length and all(c is not None and math.isfinite(c) for c in v)]


def query(spark, rows, tmp_path):
    table(spark, rows).write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
    return sorted((tuple(r) for r in registry.queries()["op12_codes"](spark, str(tmp_path)).collect()), key=str)


def vectors(n, length, seed=3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(length)] for _ in range(9)]
    return [[float(np.float32(c + rng.gauss(0, 0.05))) for c in centres[i % 9]] for i in range(n)]


def test_codes_and_odd_rows(spark, tmp_path):
    rows = [(i * 3 % 401, v, [None, 1, 2, 7][min(i % 9, 3)]) for i, v in enumerate(vectors(400, 32))]
    rows += rows[:20] + [(None, rows[3][1], 1), (None, rows[9][1], None), (2000, [0.0] * 32, 5)]
    odd = [(900, None, 1), (901, [None] * 32, 1), (902, [float("nan")] * 32, 2), (903, [float("inf")] * 32, 2), (904, [1.0] * 16, 2), (905, [1.0] * 3, 2), (906, [], 1)]
    assert query(spark, rows + odd, tmp_path) == sorted(brute.codes(usable(rows, 32)), key=str)


def test_fewer_rows_than_entries_ties_and_wide_integers(spark, tmp_path):
    rows = [(i, [float(i % 4) * 1000.0] * 16, 1) for i in range(30)] + [(50, [-200_000.0] * 16, None)]
    assert query(spark, rows, tmp_path) == sorted(brute.codes(rows), key=str)
    rows = rows[:1]
    assert query(spark, rows, tmp_path) == brute.codes(rows)


def test_components_out_of_range_are_left_out(spark, tmp_path):
    rows = [(i, v, 0) for i, v in enumerate(vectors(10, 16))]
    assert query(spark, [*rows, (99, [3e30] * 16, 0)], tmp_path) == sorted(brute.codes(rows), key=str)


def test_no_usable_row(spark, tmp_path):
    assert query(spark, [(1, None, 1), (2, [1.0, 2.0], 1)], tmp_path) == []


@pytest.mark.parametrize("folder", ["edge_dir", "odd_dir"])
def test_op12_on_edge_tables(spark, folder, request, tmp_path):
    """The edge table's vectors have 8 components: no length that 16 divides; cut into 4 parts they have codes."""
    sf = request.getfixturevalue(folder)
    assert registry.queries()["op12_codes"](spark, sf).collect() == []
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    found, books = C.compress(spark.read.parquet(f"{sf}/embeddings.parquet"), parts=4, entries=10, rounds=3)
    got = [(r.vec_id, r.codes.hex(), r.error, r.label_error, books.digest()) for r in C.with_label_errors(found).collect()]
    assert sorted(got, key=str) == sorted(brute.codes(usable(rows, 8), 4, 10, 3), key=str)
    vector = {r[0]: r[1] for r in rows}
    for r in found.where("vec_id < 20").collect():
        assert ((books.decode(r.codes) - np.array(vector[r.vec_id])) ** 2).sum() * 256 ** 2 < 4 * r.error + 64


def test_hot_labels_and_many_labels(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        rows = [(i, v, 0 if i % 3 == 0 else i) for i, v in enumerate(vectors(300, 16))]
        found, books = C.compress(table(spark, rows))
        got = [(r.vec_id, r.codes.hex(), r.error, r.label_error, books.digest()) for r in C.with_label_errors(found).collect()]
        assert sorted(got, key=str) == sorted(brute.codes(rows), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@given(st.integers(0, 10 ** 6))
def test_bounds_change_no_code_and_spare_scans(seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-500, 500, (8, 4, 3))
    x = centres[rng.integers(0, 8, 300)] + rng.integers(-30, 30, (300, 4, 3))
    x[::7] = x[0]
    history = [np.ascontiguousarray(x[:12].transpose(1, 0, 2))]
    state = C.Assignment.unknown(len(x), 4)
    scans = []
    for _ in range(6):
        state.scans = 0
        state.renew(x, history)
        scans.append(state.scans)
        exact = np.stack([((x[:, p, None] - history[-1][p]) ** 2).sum(2).argmin(1) for p in range(4)], 1)
        assert (state.codes == exact).all()
        book = history[-1].copy()
        for p in range(4):
            for k in range(12):
                if (exact[:, p] == k).any():
                    book[p, k] = x[exact[:, p] == k, p].sum(0) // (exact[:, p] == k).sum()
        history.append(book)
    assert scans[0] == 1200 and scans[-1] < 900


def test_net_displacement_is_tighter_than_drifts():
    there, back = np.zeros((1, 2, 2), int), np.zeros((1, 2, 2), int)
    away = there.copy()
    away[0, 1] = 100
    moved = C.Displacements([there, away, back])
    stamp, code = np.zeros((1, 1), int), np.zeros((1, 1), int)
    assert moved.others(stamp, code)[0, 0] == 0  # drifts would have added up to 200 * sqrt(2)
    assert C.Displacements([there, away]).others(stamp, code)[0, 0] == pytest.approx(100 * math.sqrt(2))

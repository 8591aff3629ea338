"""Vector code compression: product codes learned by exact integer k-means with norm-of-sum bounds (operator 12).

A vector's components become integers, the vector is cut into equal parts, and each part is
replaced by the index of the nearest entry of its position's codebook.  Codebooks are learned in
rounds: assign every part, then replace each entry by the floored mean of its parts.

Between rounds a part keeps two bounds as they were when they were last computed, each with the
*stamp* of that round: one above the distance to its own entry, one below the distance to any
other.  The codebooks of all rounds are retained, so a bound is brought up to date by the true
net displacement of an entry since the stamp, the norm of the sum of its moves, which is never
more than the sum of their norms that running drifts would add up.  A part whose upper bound
stays below its lower one keeps its entry without a look at the codebook; else the upper bound is
made exact; only if that does not decide, all entries are scanned again.  Bounds are rounded
outwards and compared strictly, so ties always reach the scan, whose integers are exact.

How the work is dealt: vectors, codes, bounds and stamps are one table below the checkpoint
folder for each round, so a lost task repeats its own rows only.  A task adds up its parts per
entry; the sums of all tasks, at most parts x entries x components numbers, meet in the driver,
which sends the new codebooks with the next round.  Labels that hold many rows get their sums by
a broadcast of at most four rows for each shuffle partition, the others by a join.

Defined results: vectors that are null, hold null or non-finite components, or components beyond
``LARGEST`` (whose squared distances could leave 64 bits) are left out; so are those whose length
is not the most frequent length that the number of parts divides (ties: the longer one).  Zero
vectors count.  Rows with a null id stay and come last in order, equal ids by their integers;
repeated rows count one by one.  With fewer rows than entries there are as many entries as rows.
Null labels are one label.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.scratch import pin
from sensorlake.llm.ship import ship

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LARGEST = 2.0 ** 18  # of a component, so that 2 ** 26 after scaling
ROWS = 4096          # at once
_STATE = ["codes", "upper", "lower", "upper_stamp", "lower_stamp"]
_SLACK = 1e-12       # of a norm in double precision


# ---- codebooks and bounds ---------------------------------------------------------------------------

def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows x entries) of integer rows."""
    reach = float(np.abs(x).max(initial=0)) + float(np.abs(entries).max(initial=0))
    if reach * reach * x.shape[1] < 2.0 ** 51:  # every number below is an integer that a double holds
        f, g = x.astype(np.float64), entries.astype(np.float64)
        return ((f * f).sum(1)[:, None] - 2 * (f @ g.T) + (g * g).sum(1)).astype(np.int64)
    return ((x[:, None, :] - entries) ** 2).sum(2)


def above(x: np.ndarray) -> np.ndarray:
    """Single-precision numbers not below ``x``."""
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def below(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


class Displacements:
    """Net displacements of all entries from the codebooks of every round to the newest."""

    def __init__(self, history: list[np.ndarray]):
        now = history[-1]
        moved = np.stack([np.sqrt(((now - then) ** 2).sum(2).astype(np.float64)) for then in history]) * (1 + _SLACK)
        self.entry = moved                        # round x part x entry
        self.farthest = moved.argmax(2)           # of all entries of a part position
        order = np.sort(moved, axis=2)
        self.most = order[:, :, -1]
        self.second = order[:, :, -2] if moved.shape[2] > 1 else np.zeros_like(self.most)

    def own(self, stamp: np.ndarray, code: np.ndarray) -> np.ndarray:
        return self.entry[stamp, np.arange(stamp.shape[1]), code]

    def others(self, stamp: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The largest displacement among the entries that are not the own one."""
        part = np.arange(stamp.shape[1])
        return np.where(self.farthest[stamp, part] == code, self.second[stamp, part], self.most[stamp, part])


class Assignment:
    """Codes (rows x parts) and their bounds."""

    def __init__(self, codes, upper, lower, upper_stamp, lower_stamp):
        self.codes, self.upper, self.lower, self.upper_stamp, self.lower_stamp = codes, upper, lower, upper_stamp, lower_stamp
        self.scans = 0  # parts whose distances to all entries were computed

    @staticmethod
    def unknown(rows: int, parts: int) -> Assignment:
        """Bounds that decide nothing."""
        shape = (rows, parts)
        return Assignment(np.zeros(shape, np.uint8), np.full(shape, np.inf, np.float32), np.full(shape, -np.inf, np.float32),
                          np.zeros(shape, np.uint8), np.zeros(shape, np.uint8))

    @staticmethod
    def of_columns(columns: list[pa.Array], parts: int) -> Assignment:
        kinds = [np.uint8, "<f4", "<f4", np.uint8, np.uint8]
        return Assignment(*(np.frombuffer(b"".join(c.to_pylist()), k).reshape(-1, parts).copy() for c, k in zip(columns, kinds, strict=True)))

    def columns(self) -> list[pa.Array]:
        return [_rows_binary(x) for x in (self.codes, self.upper, self.lower, self.upper_stamp, self.lower_stamp)]

    def renew(self, x: np.ndarray, history: list[np.ndarray]) -> None:
        """The nearest entries of the newest codebooks for ``x`` (rows x parts x components)."""
        now, stamp = history[-1], len(history) - 1
        moved = Displacements(history)
        lower = self.lower - moved.others(self.lower_stamp, self.codes)
        upper = self.upper + moved.own(self.upper_stamp, self.codes)
        open_ = ~(upper * (1 + _SLACK) < lower * (1 - _SLACK)) | ~(lower > 0)
        for part in range(x.shape[1]):
            rows = np.flatnonzero(open_[:, part])
            known = rows[np.isfinite(self.upper[rows, part])]
            if len(known):  # the exact distance to the own entry may decide
                gap = x[known, part] - now[part, self.codes[known, part]]
                exact = np.sqrt((gap * gap).sum(1).astype(np.float64))
                self.upper[known, part], self.upper_stamp[known, part] = above(exact), stamp
                sure = self.upper[known, part] * (1 + _SLACK) < lower[known, part] * (1 - _SLACK)
                rows = np.setdiff1d(rows, known[sure & (lower[known, part] > 0)], assume_unique=True)
            if not len(rows):
                continue
            self.scans += len(rows)
            distance = squared(x[rows, part], now[part])
            code = distance.argmin(1)  # the first of equal ones
            nearest = distance[np.arange(len(rows)), code]
            if distance.shape[1] > 1:
                distance[np.arange(len(rows)), code] = np.iinfo(np.int64).max
                self.lower[rows, part] = below(np.sqrt(distance.min(1).astype(np.float64)))
            else:
                self.lower[rows, part] = np.inf
            self.codes[rows, part] = code
            self.upper[rows, part] = above(np.sqrt(nearest.astype(np.float64)))
            self.upper_stamp[rows, part] = self.lower_stamp[rows, part] = stamp

    def errors(self, x: np.ndarray, codebooks: np.ndarray) -> np.ndarray:
        gap = x - codebooks[np.arange(x.shape[1]), self.codes]
        return (gap * gap).sum((1, 2))


# ---- columns ------------------------------------------------------------------------------------------

def _rows_binary(x: np.ndarray) -> pa.Array:
    """One binary value for each row."""
    width = x.dtype.itemsize * x.shape[1]
    return pa.array([memoryview(row) for row in np.ascontiguousarray(x).view(np.uint8).reshape(len(x), width)] if len(x) else [], pa.binary())


def _integers(column: pa.Array, parts: int, length: int) -> np.ndarray:
    """Integer vectors (rows x parts x components) from binary values of 2 or 4 bytes a component."""
    raw = column.to_pylist()
    out = np.empty((len(raw), length), np.int64)
    wide = np.array([len(r) == 4 * length for r in raw], bool)
    for kind, rows in (("<i2", np.flatnonzero(~wide)), ("<i4", np.flatnonzero(wide))):
        if len(rows):
            out[rows] = np.frombuffer(b"".join(raw[i] for i in rows.tolist()), kind).reshape(-1, length)
    return out.reshape(len(raw), parts, length // parts)


def _parts_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, ROWS):
        yield batch.slice(at, ROWS)


def _begin(length: int, parts: int, scale: int):
    """(vec_id, label, array<double>) -> vec_id, label, vector and bounds that decide nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _parts_of(whole):
                x = np.floor(batch.column(2).flatten().to_numpy(zero_copy_only=False) * scale).astype(np.int64).reshape(-1, length)
                narrow = np.abs(x).max(initial=0) < 1 << 15
                state = Assignment.unknown(len(x), parts)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _rows_binary(x.astype("<i2" if narrow else "<i4")), *state.columns()],
                                                 ["vec_id", "label", "vector", *_STATE])

    return run


def _renewed(history: list[np.ndarray], length: int, last: bool):
    """Rows with their state -> the same with codes and bounds renewed; at last, codes and errors only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = history[-1].shape[0]
        for whole in batches:
            for batch in _parts_of(whole):
                x = _integers(batch.column(2), parts, length)
                state = Assignment.of_columns(batch.columns[3:], parts)
                state.renew(x, history)
                columns, names = state.columns(), _STATE
                if last:
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), columns[0], pa.array(state.errors(x, history[-1]), pa.int64())],
                                                     ["vec_id", "label", "codes", "error"])
                else:
                    yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], ["vec_id", "label", "vector", *names])

    return run


def _sums(parts: int, entries: int, length: int):
    """(vector, codes) -> part, entry, place, total: sums of a task; place -1 has the number of parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = length // parts
        total = np.zeros((parts, entries, d + 1), np.int64)
        for whole in batches:
            for batch in _parts_of(whole):
                x = _integers(batch.column(0), parts, length)
                codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, parts)
                for part in range(parts):
                    order = np.argsort(codes[:, part], kind="stable")
                    own, first = np.unique(codes[order, part], return_index=True)
                    total[part, own, 1:] += np.add.reduceat(x[order, part], first, axis=0)
                    total[part, own, 0] += np.diff(np.append(first, len(order)))
        part, entry, place = np.nonzero(np.broadcast_to(total[:, :, :1] > 0, total.shape))
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(place - 1, pa.int32()), pa.array(total[part, entry, place], pa.int64())],
                                         ["part", "entry", "place", "total"])

    return run


# ---- learning ---------------------------------------------------------------------------------------------

class Codebooks:
    """Entries (parts x entries x components) of integer codebooks."""

    def __init__(self, entries: np.ndarray, scale: int = SCALE):
        self.entries, self.scale = entries, scale

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()

    def decode(self, codes: bytes) -> np.ndarray:
        """The vector that a code stands for, in the middle of its integers' steps."""
        own = self.entries[np.arange(len(self.entries)), np.frombuffer(codes, np.uint8)]
        return (own.reshape(-1) + 0.5) / self.scale


def usable(vectors: DataFrame, parts: int, vec_id: str, vector: str, label: str) -> tuple[DataFrame, int]:
    """``vec_id, label, x`` of the rows that take part, and their length (0: no rows)."""
    x = F.col(vector).cast("array<double>")
    fine = F.coalesce(F.forall(x, lambda v: F.coalesce(F.abs(v) <= LARGEST, F.lit(False))), F.lit(False))
    rows = vectors.where(fine).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), x.alias("x"))
    lengths = rows.groupBy(F.size("x").alias("length")).count().where((F.col("length") > 0) & (F.col("length") % parts == 0))
    best = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    length = best["length"] if best else 0
    return rows.where(F.size("x") == length), length


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, Codebooks]:
    """``vec_id, label, codes, error`` of every vector that takes part (one byte for each part; written), and the codebooks."""
    spark = vectors.sparkSession
    ship(spark)
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte for each part")
    kind = vectors.schema[label].dataType.simpleString()
    rows, length = usable(vectors, parts, vec_id, vector, label)
    if not length:
        return spark.createDataFrame([], f"vec_id long, label {kind}, codes binary, error long"), Codebooks(np.zeros((parts, 0, 1), np.int64), scale)
    whole = F.transform("x", lambda v: F.floor(v * scale).cast("long"))
    first = rows.select("vec_id", whole.alias("x")).orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).collect()
    book = np.array([r["x"] for r in first], np.int64).reshape(len(first), parts, length // parts).transpose(1, 0, 2)
    history = [np.ascontiguousarray(book)]
    head = f"vec_id long, label {kind}"
    schema = f"{head}, vector binary, " + ", ".join(f"{c} binary" for c in _STATE)
    state = rows.mapInArrow(_begin(length, parts, scale), schema)
    for _ in range(rounds):
        state = pin(state.mapInArrow(_renewed(history, length, False), schema), "codes")
        sums = (state.select("vector", "codes").mapInArrow(_sums(parts, len(first), length), "part int, entry int, place int, total long")
                .groupBy("part", "entry", "place").agg(F.sum("total").alias("total")).collect())
        book = history[-1].copy()
        count = {(r["part"], r["entry"]): r["total"] for r in sums if r["place"] < 0}
        for r in sums:
            if r["place"] >= 0:
                book[r["part"], r["entry"], r["place"]] = r["total"] // count[r["part"], r["entry"]]
        history.append(book)
    found = state.mapInArrow(_renewed(history, length, True), f"{head}, codes binary, error long")
    return pin(found, "codes"), Codebooks(history[-1], scale)


def with_label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with ``label_error``: the errors of all rows with the row's label added up."""
    spark = codes.sparkSession
    per = pin(codes.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("rows")), "label-errors")
    total = per.agg(F.sum("rows")).first()[0] or 0
    pieces = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    sums = per.select(F.col("label").alias("_label"), "label_error", (F.col("rows") * pieces >= total).alias("hot"))
    same = F.col("label").eqNullSafe(F.col("_label"))
    hot = F.broadcast(sums.where("hot").drop("hot"))  # at most `pieces` rows
    hot_rows = codes.join(hot, same)
    other = codes.join(hot, same, "left_anti").join(sums.where("not hot").drop("hot"), same)
    return hot_rows.unionByName(other).drop("_label")

"""Token-id files with a minimal perfect hash index (operator 6).

A token file is a table of segments in ascending id order, each written by one task:
the raw ids of some thousand documents as little-endian integers of 16 or 32 bits, and
an index of document key -> place.  The index is a minimal perfect hash by displacement:
a key's bucket holds the displacement that sends all of its keys to free slots, so n keys
fill n slots and a key is found by one bucket and one slot.  A slot stores a fingerprint
of its key, so a foreign key is refused, and the document's offset and length.

The key of a document is its id and its number among equal ids of the segment.  A segment
names its least and greatest id, and the segments lie in ascending order, so ``lookup`` goes
from an id to its segments by range, and from there to the document by the hash.  Segments
are rows of a Parquet table, so they live in any store that Spark reaches, are committed
by Spark as a whole, and a lost task writes its own again.

Defined results: a null text is an empty one; rows with a null id come first; repeated ids
are kept, in the order of their texts' hashes; an empty table gives an empty file.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm import words as W
from sensorlake.llm.running import running_total
from sensorlake.llm.scratch import pin
from sensorlake.llm.ship import send, ship
from sensorlake.llm.wordids import WordEncoder

SEGMENT_BYTES = 1 << 20  # of text
PARTITION_BYTES = 32 << 20
ROW_BYTES = 64         # of a row besides its text
SEGMENT = "part int, seq int, n_docs int, n_tokens long, width int, least long, greatest long, nulls int, keys binary, payload binary, seeds binary, slots binary"
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_SLOT = np.dtype([("fingerprint", "<u4"), ("length", "<u4"), ("offset", "<u8")])
_KEY = np.dtype([("doc_id", "<i8"), ("copy", "<u4"), ("null", "u1")])


# ---- minimal perfect hash --------------------------------------------------------------------

def key_hashes(keys: np.ndarray) -> np.ndarray:
    h = W.mix64(keys["doc_id"].view(np.uint64) if keys["doc_id"].flags.c_contiguous else keys["doc_id"].astype("<i8").view(np.uint64))
    return W.mix64(h + keys["copy"].astype(np.uint64) * _GOLDEN + keys["null"].astype(np.uint64))


def fingerprints(h: np.ndarray) -> np.ndarray:
    return (W.mix64(h ^ _GOLDEN) >> np.uint64(32)).astype(np.uint32)


def build_hash(h: np.ndarray) -> np.ndarray:
    """Displacements of the buckets; a single key's is ``-1 - slot``."""
    n = len(h)
    seeds = np.zeros(max(1, -(-n // 4)), np.int32)
    bucket = (h >> np.uint64(32)).astype(np.int64) % len(seeds)
    order = np.argsort(bucket, kind="stable")
    begin = np.searchsorted(bucket[order], np.arange(len(seeds) + 1))
    sizes = np.diff(begin)
    taken = np.zeros(n, bool)
    tries = np.arange(64, dtype=np.uint64)
    for b in np.argsort(-sizes, kind="stable"):
        if sizes[b] < 2:
            break
        own, first = h[order[begin[b]:begin[b + 1]]], 0
        while True:
            slots = _slots(own[:, None], tries[None, :] + np.uint64(first), n)
            fits = ~taken[slots].any(0)
            for k in np.flatnonzero(fits):
                if len(np.unique(slots[:, k])) == len(own):
                    break
            else:
                first += 64
                continue
            seeds[b] = first + k
            taken[slots[:, k]] = True
            break
    single = np.flatnonzero(sizes == 1)
    seeds[single] = -1 - np.flatnonzero(~taken)[:len(single)]
    return seeds


def _slots(h, seed, n: int) -> np.ndarray:
    return (W.mix64(h + (seed + np.uint64(1)) * _GOLDEN) % np.uint64(n)).astype(np.int64)


def slots_of(h: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    seed = seeds[(h >> np.uint64(32)).astype(np.int64) % len(seeds)].astype(np.int64)
    return np.where(seed < 0, -1 - seed, _slots(h, np.maximum(seed, 0).astype(np.uint64), n))


class Segment:
    """Keyed access to the documents of one segment row."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["payload"], "<u2" if row["width"] == 2 else "<u4")
        self.seeds, self.slots = np.frombuffer(row["seeds"], "<i4"), np.frombuffer(row["slots"], _SLOT)
        self.keys = np.frombuffer(row["keys"], _KEY)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The slot entries of the keys; a key that is not in the segment has length 0 and offset -1."""
        out = np.zeros(len(keys), np.dtype([("offset", "<i8"), ("length", "<i8")]))
        out["offset"] = -1
        if len(self.slots):
            h = key_hashes(keys)
            found = self.slots[slots_of(h, self.seeds, len(self.slots))]
            right = found["fingerprint"] == fingerprints(h)
            out["offset"][right], out["length"][right] = found["offset"][right], found["length"][right]
        return out

    def get(self, doc_id: int | None, copy: int = 0) -> np.ndarray | None:
        key = np.array([(doc_id or 0, copy, doc_id is None)], _KEY)
        at = self.places(key)[0]
        return None if at["offset"] < 0 else self.ids[at["offset"]:at["offset"] + at["length"]]


# ---- writing ------------------------------------------------------------------------------------

class LibraryEncoder(WordEncoder):
    """The tokenizers library, asked once for each word that a worker has not met."""

    _open: dict[str, LibraryEncoder] = {}

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()

    @staticmethod
    def of(name: str) -> LibraryEncoder:
        if name not in LibraryEncoder._open:
            LibraryEncoder._open[name] = LibraryEncoder(SparkFiles.get(name))
        return LibraryEncoder._open[name]

    def word_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for i in range(0, len(words), 5_000)
                 for e in self.tokenizer.encode_batch_fast([w.decode() for w in words[i:i + 5_000]], add_special_tokens=False)]
        count = np.array([len(x) for x in found], np.int64)
        return np.fromiter((i for x in found for i in x), np.int32, int(count.sum())), count


def _keys(ids: pa.Array) -> np.ndarray:
    """The keys of a segment's documents, whose ids ascend, null ones first."""
    null = ids.is_null().to_numpy(zero_copy_only=False)
    keys = np.zeros(len(ids), _KEY)
    keys["doc_id"], keys["null"] = ids.fill_null(0).to_numpy(), null
    new = np.append(True, (keys["doc_id"][1:] != keys["doc_id"][:-1]) | (null[1:] != null[:-1]))[:len(keys)]
    at = np.arange(len(keys))
    keys["copy"] = at - np.maximum.accumulate(np.where(new, at, 0))
    return keys


def _segments(name: str, end: int, width: int):
    """Sorted (doc_id, text) -> segment rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        encoder = LibraryEncoder.of(name)
        for whole in batches:
            for batch in W.slices(whole, 1, SEGMENT_BYTES):
                ids, lengths = encoder.encode(*W.text_bytes(batch.column(1)), end=end)
                keys = _keys(batch.column(0))
                h = key_hashes(keys)
                seeds = build_hash(h)
                at = slots_of(h, seeds, len(h))
                slots = np.zeros(len(h), _SLOT)
                slots["fingerprint"][at], slots["length"][at], slots["offset"][at] = fingerprints(h), lengths, np.cumsum(lengths) - lengths
                payload = ids.astype("<u2" if width == 2 else "<u4")
                own = keys["doc_id"][keys["null"] == 0]
                range_ = [int(own[0]), int(own[-1])] if len(own) else [None, None]
                row = [part, seq, len(lengths), int(lengths.sum()), width, *range_, len(keys) - len(own),
                       keys.tobytes(), payload.tobytes(), seeds.astype("<i4").tobytes(), slots.tobytes()]
                kinds = [pa.int32()] * 3 + [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32()] + [pa.binary()] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in zip(row, kinds, strict=True)],
                    [c.split()[0] for c in SEGMENT.split(", ")])
                seq += 1

    return run


def write_tokens(docs: DataFrame, vocabulary: str, end: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text and write the segments in ascending id order; returns the written table."""
    spark = docs.sparkSession
    ship(spark)
    name = send(spark, vocabulary)
    from tokenizers import Tokenizer

    width = 2 if max(Tokenizer.from_file(vocabulary).get_vocab_size(), end + 1) <= 1 << 16 else 4
    body = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    size = body.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES)).first()[0] or 0
    # the last column only deals equal rows to many tasks
    order = ["doc_id", F.xxhash64("text"), F.monotonically_increasing_id()]
    # a task streams its texts in slices, so a partition may be large; more than the cluster's own number gain nothing
    parts = min(1 + size // PARTITION_BYTES, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = body.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return pin(ranged.mapInArrow(_segments(name, end, width), SEGMENT), "token-file", rows_per_file=64)


# ---- reading --------------------------------------------------------------------------------------

def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments -> one row per document, found by its key through the index."""
    for batch in batches:
        for row in batch.to_pylist():
            segment = Segment(row)
            at = segment.places(segment.keys)
            sums = [zlib.crc32(segment.ids[o:o + n].astype("<u4").tobytes()) for o, n in zip(at["offset"], at["length"], strict=True)]
            n = len(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["part"]] * n, pa.int32()), pa.array([row["seq"]] * n, pa.int32()),
                 pa.array(segment.keys["doc_id"].astype(np.int64), mask=segment.keys["null"] == 1),
                 pa.array(at["offset"].astype(np.int64)), pa.array(at["length"].astype(np.int64)), pa.array(sums, pa.int64())],
                ["part", "seq", "doc_id", "offset", "n_tokens", "ids_crc32"])


def read_documents(segments: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document of a token file."""
    heads = segments.select("part", "seq", "n_tokens")
    starts = running_total(heads, "n_tokens", [], [["part"]], ["seq"], "first").select("part", "seq", "first")
    found = segments.mapInArrow(_read, "part int, seq int, doc_id long, offset long, n_tokens long, ids_crc32 long")
    return found.join(starts, ["part", "seq"]).select("doc_id", (F.col("first") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments with the ids that are asked of them -> one row for each document found."""
    for batch in batches:
        for row in batch.to_pylist():
            segment = Segment(row)
            out = []
            for doc_id in row["asked"]:
                copy = 0
                while (ids := segment.get(doc_id, copy)) is not None:
                    out.append((doc_id, copy, ids.tolist()))
                    copy += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int64()), pa.array([row["part"]] * len(out), pa.int32()), pa.array([row["seq"]] * len(out), pa.int32()),
                 pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.list_(pa.int32()))],
                ["doc_id", "part", "seq", "copy", "ids"])


def lookup(segments: DataFrame, keys: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, part, seq, copy, ids`` of every document that has one of the ids in ``keys``.

    An id finds its partitions among their ranges (a broadcast of one row for each, at most four times the
    session's shuffle partitions), its segments among the ranges of those partitions, and its documents by the
    hash of the segment.  Payloads are read of segments that are asked for only; repeated and null ids of
    ``keys`` count once and not at all; an id that no segment holds gives no row."""
    ship(segments.sparkSession)
    asked = keys.select(F.col(doc_id).cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    heads = segments.select("part", "seq", "least", "greatest").where("least is not null")
    parts = heads.groupBy("part").agg(F.min("least").alias("low"), F.max("greatest").alias("high"))
    near = asked.join(F.broadcast(parts), (F.col("doc_id") >= F.col("low")) & (F.col("doc_id") <= F.col("high"))).select("doc_id", "part")
    hits = near.join(heads, "part").where((F.col("doc_id") >= F.col("least")) & (F.col("doc_id") <= F.col("greatest")))
    wanted = hits.groupBy("part", "seq").agg(F.collect_list("doc_id").alias("asked"))  # ids of one segment's range
    whole = segments.select("part", "seq", "width", "keys", "payload", "seeds", "slots").join(wanted, ["part", "seq"])
    return whole.mapInArrow(_found, "doc_id long, part int, seq int, copy int, ids array<int>")

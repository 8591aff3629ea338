"""Near-duplicate groups with SetSketch registers (operator 3).

A text's set is that of its ``WIDTH``-word shingles.  Its sketch has ``REGISTERS``
registers; a register holds ``floor(1 - log_b x)``, truncated to 16 bits, of the
smallest exponential variable x that its hash function gives to the set.  Sketches
of parts merge by the register-wise maximum, and equal registers are as likely as
the sets are similar.

1. Texts with the same words are one class; only classes are compared.
2. Every ``ROWS`` registers make a band; classes that share a band value are a bucket.
3. Pairs of a bucket are kept if the joint likelihood of their registers (numbers of
   larger, smaller and equal ones, with the known set sizes) puts the similarity no more
   than ``MARGIN`` below the threshold.  A pair is looked at in its first common band only.
4. Pairs that are left are confirmed on the full sets.
5. Links join classes to components.

The bands are worked off in two rounds.  The first ``FIRST`` bands' links are contracted to
components; the other bands then look at pairs of different components only.  So a group of
copies gives links in proportion to its classes, not to its pairs:

* A small bucket gives its likely pairs, at most ``LARGE / 2`` for each class, to one join with
  the sets; of its confirmed pairs a spanning forest is left.
* A bucket of more than ``LARGE`` classes first has some classes, drawn by hash, compared with
  all others (``star_links``), which joins copies of one text in linear time.  In the second
  round the component that holds most of the bucket is its *main* one.  Pairs inside it need no
  look; the classes outside it, in blocks of ``BLOCK``, are compared with each other and with
  the main one's blocks, and a task returns a spanning forest of the components it joined.  A
  bucket that is one component is left out.

No component is lost: every pair of a bucket is compared in its first common band, unless its
classes are in one component already.

With 32 bands of 5 registers a pair at similarity 0.85 is missed with probability
``(1 - 0.85 ** 5) ** 32``, 7e-9; at 0.8 with 3e-6.  Shingles are compared by 64-bit hashes.

Defined results: null and empty texts have links with nothing; an empty text's set is empty.
Rows with a null id are compared like others: they link what is similar to them, and their
component is that of the smallest id they reach, null if there is none.  A row is kept if it has
its component's id, if its component has none, or if it has no words.  Repeated rows share a class;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm import words as W
from sensorlake.llm.components import connected_components
from sensorlake.llm.scratch import pin
from sensorlake.llm.ship import ship

WIDTH = 5
ROWS, BANDS = 5, 32
REGISTERS = ROWS * BANDS
BASE, RATE = 1.001, 20.0
MARGIN = 0.14
LARGE, BLOCK = 32, 256
FIRST = 4      # bands of the first round
LEADERS = 8    # classes of a large bucket that are compared with all others, on average
SLICE = 1 << 20

_RANDOM = np.random.default_rng(20240229)
_FACTOR = _RANDOM.integers(0, 1 << 31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_TERM = _RANDOM.integers(0, 1 << 32, REGISTERS, dtype=np.uint64).astype(np.uint32)


# ---- sketches ---------------------------------------------------------------------------

def registers(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Registers (texts x REGISTERS, uint16) of the shingle hashes of texts that have at least one."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.empty((len(ends) - 1, REGISTERS), np.uint32)
    for i in range(REGISTERS):
        least[:, i] = np.minimum.reduceat(short * _FACTOR[i] + _TERM[i], ends[:-1])
    x = -np.log1p(-(least + 0.5) / 2.0 ** 32) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, 65535).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of register pairs (rows) with set sizes ``n_a, n_b``."""
    more, less = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    j = np.linspace(0, 1, 101)[None, :] * np.minimum(u / v, v / u)
    p = lambda x: -np.log1p(-np.clip(x, 1e-9, 1) * (BASE - 1) / BASE) / np.log(BASE)
    up, down = p(u - v * j), p(v - u * j)
    score = more * np.log(up) + less * np.log(down) + (a.shape[1] - more - less) * np.log(np.maximum(1 - up - down, 1e-9))
    return j[np.arange(len(j)), score.argmax(1)]


def class_keys(words: np.ndarray, offsets: np.ndarray) -> list[bytes | None]:
    """16 bytes for the word sequence of each text; None without words."""
    counts = np.diff(offsets)
    some = np.flatnonzero(counts)
    out: list[bytes | None] = [None] * len(counts)
    if len(some):
        parts = []
        for base in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F | 1):
            n = len(words)
            sums = np.add.reduceat(words * W.powers(n, base), offsets[:-1][some]) * W.powers(n, W.inverse(base))[offsets[:-1][some]]
            parts.append(W.mix64(sums + counts[some].astype(np.uint64)))
        raw = np.stack(parts, 1).astype(">u8").tobytes()
        for k, i in enumerate(some):
            out[i] = raw[16 * k:16 * k + 16]
    return out


def _distinct(hashes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each text, sorted, and their offsets."""
    owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    return h[new], np.searchsorted(o[new], np.arange(len(ends)))


def sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) -> doc_id, key, n_shingles, registers."""
    for whole in batches:
        for batch in W.slices(whole, 1, SLICE):
            words, offsets = W.word_hashes(*W.text_bytes(batch.column(1)))
            hashes, ends = _distinct(*W.shingle_hashes(words, offsets, WIDTH))
            counts = np.diff(ends)
            some = counts > 0
            regs: list[bytes | None] = [None] * len(counts)
            if some.any():
                found = registers(hashes, np.append(ends[:-1][some], len(hashes)))
                for k, i in enumerate(np.flatnonzero(some)):
                    regs[i] = found[k].astype("<u2").tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(class_keys(words, offsets), pa.binary()), pa.array(counts, pa.int64()), pa.array(regs, pa.binary())],
                ["doc_id", "key", "n_shingles", "registers"])


def key_batches(text: int):
    """Rows -> the same rows and, as ``key``, the class key of column number ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in W.slices(whole, text, SLICE):
                keys = class_keys(*W.word_hashes(*W.text_bytes(batch.column(text))))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], [*batch.schema.names, "key"])

    return run


def shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, text) -> key and its sorted shingle hashes, for the texts that have this key."""
    for whole in batches:
        for batch in W.slices(whole, 1, SLICE):
            words, offsets = W.word_hashes(*W.text_bytes(batch.column(1)))
            hashes, ends = _distinct(*W.shingle_hashes(words, offsets, WIDTH))
            keys = class_keys(words, offsets)
            kept = [i for i, k in enumerate(batch.column(0).to_pylist()) if k == keys[i]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[i] for i in kept], pa.binary()), pa.array([hashes[ends[i]:ends[i + 1]].tobytes() for i in kept], pa.binary())],
                ["key", "shingles"])


# ---- candidate pairs --------------------------------------------------------------------

def band_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, registers) -> key, value: a row for each band; the value's lowest bits tell the band."""
    for batch in batches:
        if not batch.num_rows:
            continue
        regs = _matrix(batch.column(1))
        packed = np.zeros((len(regs), BANDS), np.uint64)
        for i in range(ROWS):
            packed = W.mix64(packed * np.uint64(0x9E3779B97F4A7C15) + regs[:, i::ROWS].astype(np.uint64) + np.uint64(1))
        values = (packed & ~np.uint64(BANDS - 1)) | np.arange(BANDS, dtype=np.uint64)
        keys = batch.column(0).take(pa.array(np.repeat(np.arange(len(regs)), BANDS)))
        yield pa.RecordBatch.from_arrays([keys, pa.array(values.reshape(-1).view(np.int64))], ["key", "value"])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(len(column), REGISTERS)


def likely(regs_a, regs_b, n_a, n_b, band: int | None, threshold: float) -> np.ndarray:
    """Which pairs (rows) meet first in this band, or in any if it is None, and may be linked."""
    out = np.zeros(len(regs_a), bool)
    at = np.arange(len(regs_a))
    if band is not None:
        same = (regs_a == regs_b).reshape(len(regs_a), BANDS, ROWS).all(2)
        at = np.flatnonzero(same.argmax(1) == band)
    if len(at):
        out[at] = similarity(regs_a[at], regs_b[at], n_a[at], n_b[at]) >= threshold - MARGIN
    return out


def small_pairs(threshold: float):
    """Rows (value, key, n_shingles, registers) sorted by value -> value and the likely pairs a < b of each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            values = table.column(0).to_numpy()
            last = int(np.searchsorted(values, values[-1])) if len(values) else 0  # its bucket may go on
            if last:
                yield pairs(table.slice(0, last))
            rest = table.slice(last)
        if rest is not None and rest.num_rows:
            yield pairs(rest)

    def pairs(table: pa.Table) -> pa.RecordBatch:
        values, keys = table.column(0).to_numpy(), table.column(1).to_pylist()
        sizes, regs = table.column(2).to_numpy(), _matrix(table.column(3).combine_chunks())
        begin = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
        length = np.diff(np.append(begin, len(values)))
        left, right = [], []
        for n in np.unique(length):  # all buckets of one size at once
            i, j = np.triu_indices(n, 1)
            at = begin[length == n][:, None]
            left.append((at + i).ravel())
            right.append((at + j).ravel())
        left, right = np.concatenate(left), np.concatenate(right)
        found: list[tuple[int, bytes, bytes]] = []
        for k in range(0, len(left), 4096):
            a, b = left[k:k + 4096], right[k:k + 4096]
            bands = (values[a].view(np.uint64) & np.uint64(BANDS - 1)).astype(int)
            for x, y in zip(*_kept(regs, sizes, a, b, bands, threshold), strict=True):
                found.append((values[x], min(keys[x], keys[y]), max(keys[x], keys[y])))
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.binary(), pa.binary()))], ["value", "a", "b"])

    return run


def _kept(regs, sizes, a, b, bands, threshold):
    keep = likely(regs[a], regs[b], sizes[a], sizes[b], bands, threshold)
    return a[keep], b[keep]


def linked(common: np.ndarray | int, n_a: np.ndarray | int, n_b: np.ndarray | int, percent: int):
    return 100 * common >= percent * (n_a + n_b - common)


def confirmed_pairs(percent: int):
    """Rows (value, a, b, shingles of a, shingles of b) -> value and the linked pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(3), batch.column(4), strict=True):
                keep.append(_confirmed(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent))
            yield pa.RecordBatch.from_arrays(batch.columns[:3], ["value", "a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _confirmed(s: np.ndarray, t: np.ndarray, percent: int) -> bool:
    return bool(linked(len(np.intersect1d(s, t, assume_unique=True)), len(s), len(t), percent))


class Forest:
    """Sets of nodes that links have joined."""

    def __init__(self):
        self.parent: dict = {}

    def root(self, x):
        parent = self.parent
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x, y) -> bool:
        """Whether the link joined two sets."""
        x, y = self.root(x), self.root(y)
        if x != y:
            self.parent[x] = y
        return x != y


def spanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) -> those of a batch that join what no earlier one had joined."""
    for batch in batches:
        forest = Forest()
        keep = [forest.join(x, y) for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def star_links(percent: int):
    """A block of a bucket's classes and its leaders -> links between a leader and a class."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        keys, leads = table.column("key").to_pylist(), table.column("leads").to_numpy(zero_copy_only=False)
        regs, sizes = _matrix(table.column("registers").combine_chunks()), table.column("n_shingles").to_numpy()
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in table.column("shingles")]
        forest, links = Forest(), []
        own = np.flatnonzero(~leads)
        for x in np.flatnonzero(leads):
            at = np.full(len(own), x)
            for y in own[likely(regs[at], regs[own], sizes[at], sizes[own], None, percent / 100)]:
                if keys[x] != keys[y] and forest.root(keys[x]) != forest.root(keys[y]) and _confirmed(sets[x], sets[y], percent):
                    forest.join(keys[x], keys[y])
                    links.append((keys[x], keys[y]))
        return pa.table({"a": pa.array([x for x, _ in links], pa.binary()), "b": pa.array([y for _, y in links], pa.binary())})

    return run


def block_links(percent: int):
    """All rows of two blocks of a bucket -> links that span the components which they join."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        labels, block = table.column("label").to_pylist(), table.column("block").to_numpy()
        regs, sizes = _matrix(table.column("registers").combine_chunks()), table.column("n_shingles").to_numpy()
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in table.column("shingles")]
        band = int(np.uint64(table.column("value")[0].as_py() & (BANDS - 1)))
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        number = {label: n for n, label in enumerate(dict.fromkeys(labels))}
        names, own = list(number), np.array([number[label] for label in labels])
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        forest, links = Forest(), []
        for x in left:
            other = right[right > x] if i == j else right
            other = other[own[other] != own[x]]
            at = np.full(len(other), x)
            other = other[likely(regs[at], regs[other], sizes[at], sizes[other], band, percent / 100)] if len(other) else other
            for y in other:
                if forest.root(own[x]) != forest.root(own[y]) and _confirmed(sets[x], sets[y], percent):
                    forest.join(own[x], own[y])
                    links.append((names[own[x]], names[own[y]]))
        return pa.table({"a": pa.array([x for x, _ in links], pa.binary()), "b": pa.array([y for _, y in links], pa.binary())})

    return run


# ---- groups -------------------------------------------------------------------------------

def with_keys(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` and the class key of each row's text as ``key``; null without words."""
    ship(docs.sparkSession)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), "key binary"])
    return docs.mapInArrow(key_batches(docs.columns.index(text)), schema)


def near_duplicates(docs: DataFrame, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row; links at ``percent`` / 100 or more."""
    return groups(docs, percent, doc_id, text).select("doc_id", "n_shingles", "component_id", "kept")


def groups(docs: DataFrame, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns of ``near_duplicates``, each row's class ``key``, and ``component_key``.

    Ids may repeat over different texts or be null, so ``component_id`` may name several components; the pair
    ``component_id, component_key`` is a class of one component only, the least of its pairs of id and key
    (null ids last)."""
    ship(docs.sparkSession)
    body = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sketched = pin(body.mapInArrow(sketch_batches, "doc_id long, key binary, n_shingles long, registers binary"), "sketches")
    nodes = pin(sketched.where("key is not null").groupBy("key").agg(
        F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"),
        F.count("*").alias("rows")), "classes")
    bands = nodes.select("key", "registers").mapInArrow(band_values, "key binary, value long")
    full = pin(bands.groupBy("value").agg(F.count("*").alias("members")).where("members > 1"), "buckets")
    members = pin(bands.join(full, "value"), "members")

    rich = nodes.select("key", "n_shingles", "registers")
    small = (members.where(F.col("members") <= LARGE).select("value", "key").join(rich, "key")
             .select("value", "key", "n_shingles", "registers").repartition("value").sortWithinPartitions("value"))
    pairs = pin(small.mapInArrow(small_pairs(percent / 100), "value long, a binary, b binary"), "pairs")
    crowd = members.where(F.col("members") > LARGE)
    sets = _sets(body, nodes, pairs, crowd)

    early = F.col("value").bitwiseAND(F.lit(BANDS - 1)) < FIRST  # the lowest bits tell the band
    links = _confirm(pairs.where(early), sets, percent).union(_star(crowd.where(early), rich, sets, percent))
    labels = connected_components(pin(links, "confirmed"))
    names = labels.select("key", "label")

    own = lambda c: F.coalesce(F.col(f"{c}_label"), F.col(c)).alias(c)
    apart = pairs.where(~early)
    for c in "ab":
        apart = apart.join(names.select(F.col("key").alias(c), F.col("label").alias(f"{c}_label")), c, "left")
    apart = apart.where(F.coalesce("a_label", "a") != F.coalesce("b_label", "b"))
    late = _confirm(apart.select("value", "a", "b"), sets, percent)
    for c in "ab":
        late = late.join(names.select(F.col("key").alias(c), F.col("label").alias(f"{c}_label")), c, "left")
    late = late.select(own("a"), own("b")).union(_crowded(crowd, names, rich, sets, percent))
    merged = connected_components(pin(late, "confirmed")).withColumnRenamed("key", "name").withColumnRenamed("label", "last")

    every = nodes.select("key", "first_id", "rows").join(names, "key", "left").withColumn("name", F.coalesce("label", "key"))
    every = every.join(merged, "name", "left").select("key", "first_id", "rows", F.coalesce("last", "name").alias("label"))
    every = pin(every, "labels")
    smallest = every.groupBy("label").agg(F.min(F.struct(F.isnull("first_id"), "first_id", "key")).alias("least"))
    every = pin(every.join(smallest, "label").select(
        F.col("key").alias("_key"), "rows", F.col("least.first_id").alias("component_id"), F.col("least.key").alias("component_key")), "components")
    return _with_components(sketched.select("doc_id", "key", "n_shingles"), every)


def _sets(body: DataFrame, nodes: DataFrame, pairs: DataFrame, crowd: DataFrame) -> DataFrame:
    """``key, shingles`` of the classes that are compared, from the texts of their first documents."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("key")).union(crowd.select("key")).distinct()
    firsts = pin(nodes.join(asked, "key").select("key", F.col("first_id").alias("doc_id")), "asked")
    # by key too: an id may have many texts; the asked grow with the documents
    texts = with_keys(body.where("doc_id is not null")).join(firsts.where("doc_id is not null").hint("merge"), ["doc_id", "key"]).select("key", "text")
    # classes without an id: their texts are reduced where they are, as one may hold many rows
    nameless = with_keys(body.where("doc_id is null")).where("key is not null").groupBy("key").agg(F.min("text").alias("text"))
    texts = texts.union(nameless.join(firsts.where("doc_id is null").select("key"), "key").select("key", "text"))
    return pin(texts.mapInArrow(shingle_sets, "key binary, shingles binary").groupBy("key").agg(F.first("shingles").alias("shingles")), "sets")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The linked ones of small buckets' pairs ``value, a, b``, a spanning forest of each bucket's."""
    one, two = (sets.select(F.col("key").alias(c), F.col("shingles").alias(f"_{c}")) for c in "ab")
    sure = pairs.join(one, "a").join(two, "b").select("value", "a", "b", "_a", "_b").mapInArrow(confirmed_pairs(percent), "value long, a binary, b binary")
    return sure.repartition("value").select("a", "b").mapInArrow(spanning, "a binary, b binary")


def _star(crowd: DataFrame, rich: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of large buckets' leaders with the classes of their buckets, each block on its own."""
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    hashed = F.xxhash64("key", "value")
    placed = crowd.select("value", "key", F.pmod(hashed, blocks).cast("int").alias("block"), F.lit(False).alias("leads"))
    leaders = crowd.where(F.pmod(F.xxhash64("value", "key"), F.col("members")) < LEADERS)
    leaders = leaders.select("value", "key", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.lit(True).alias("leads"))
    return (placed.union(leaders).join(rich, "key").join(sets, "key").groupBy("value", "block")
            .applyInArrow(star_links(percent), "a binary, b binary"))


def _crowded(crowd: DataFrame, names: DataFrame, rich: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components that meet in large buckets."""
    crowd = pin(crowd.join(names, "key", "left").withColumn("label", F.coalesce("label", "key")), "crowd")
    per = crowd.groupBy("value", "label").agg(F.count("*").alias("n"))
    main = per.groupBy("value").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.max("n").alias("inside"))
    open_ = crowd.join(main, "value").where("inside < members")
    rest = F.ceil((F.col("members") - F.col("inside")) / BLOCK).cast("int")
    blocks = rest + F.ceil(F.col("inside") / BLOCK).cast("int")
    hashed = F.xxhash64("key", "value")
    outside = F.col("label") != F.col("main")
    block = F.when(outside, F.pmod(hashed, rest)).otherwise(rest + F.pmod(hashed, blocks - rest)).cast("int")
    others = F.sequence(F.lit(0), F.when(outside, blocks).otherwise(rest) - 1)  # blocks of the main component are not compared with each other
    placed = open_.select("value", "key", "label", block.alias("block"), F.explode(others).alias("other"))
    placed = placed.select("value", "key", "label", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    return placed.join(rich, "key").join(sets, "key").groupBy("value", "i", "j").applyInArrow(block_links(percent), "a binary, b binary")


def _with_components(rows: DataFrame, every: DataFrame) -> DataFrame:
    """The rows with their classes' components.  Classes of many rows reach them by a broadcast of at most
    four rows for each shuffle partition, so that no join deals the copies of one text to one task."""
    pieces = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = every.agg(F.sum("rows")).first()[0] or 0
    hot = F.broadcast(every.where(F.col("rows") * pieces >= total).drop("rows"))
    worded, same = rows.where("key is not null"), F.col("key") == F.col("_key")
    found = worded.join(hot, same).unionByName(worded.join(hot, same, "left_anti").join(every.where(F.col("rows") * pieces < total).drop("rows"), same))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    found = found.select("doc_id", "n_shingles", F.col("component_id").cast("long").alias("component_id"), kept.alias("kept"), "key", "component_key")
    wordless = rows.where("key is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"),
                                                "key", F.lit(None).cast("binary").alias("component_key"))
    return found.unionByName(wordless)

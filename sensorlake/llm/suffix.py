"""Removal of long byte strings that occur more than once, by suffix arrays (operator 10).

Every byte that lies in a string of ``LENGTH`` bytes which also starts anywhere else goes.

1. Equal texts are one class; a text of at least ``LENGTH`` bytes with a copy goes whole.
   One text of each class takes part in the search.
2. A window is ``LENGTH`` bytes at one position.  Its anchor is the least hash among its
   ``GRAM``-byte strings, which depends on the window's content alone, so equal windows
   have equal anchors.  Neighbouring windows with one anchor make a piece.  Pieces whose
   anchor occurs once in the corpus hold no repeated window and are done.
3. The other pieces are dealt to shards by anchor.  A shard sorts all suffixes of its pieces
   by Larsson and Sadakane's refinement (groups of equal prefixes, doubled in length each
   round; sorted suffixes are left alone) and finds their common prefixes by Kasai's scan,
   which runs along all pieces in step.  A window is repeated if its suffix shares ``LENGTH``
   bytes with a neighbour in the array.
4. The pieces of an anchor with more than ``HOT`` occurrences are spread over several shards.
   Such shards hand on their windows' fingerprints in sorted runs, dealt into parts by the
   fingerprint, and the runs of all shards are merged by binary search.

So no shard grows with a common passage, and every shard is compared with those that can
share a window with it, not with all others.  Hashes: 64 bits for anchors (a collision costs
time only), 128 bits for classes and for windows merged across shards.

Defined results: a null text is an empty one; texts under ``LENGTH`` bytes are never cut;
repeated rows are copies of each other; rows with null ids take part like others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.llm import words as W
from sensorlake.llm.scratch import pin
from sensorlake.llm.ship import ship

LENGTH, GRAM = 200, 64
LONGEST_PIECE = 256  # windows
HOT = 1024
SHARD_BYTES = 1_500_000
MERGE_ROWS = 100_000
SLICE = 1 << 18


# ---- pieces ---------------------------------------------------------------------------------

def gram_hashes(data: np.ndarray, width: int, base: int = 0xD1342543DE82EF95) -> np.ndarray:
    """The hash of the ``width`` bytes at every position that has so many."""
    n = len(data)
    if n < width:
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * W.powers(n, base), out=sums[1:])
    return W.mix64((sums[width:] - sums[:-width]) * W.powers(n, W.inverse(base))[:n - width + 1])


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def pieces_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Owner, begin (in the owner), windows, anchor and times of the pieces of all texts.

    ``times`` is 2 if the anchor's string stands in the piece more than once (as in a text of
    one word), so that its windows may equal one another; else 1.
    """
    empty = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return empty, empty, empty, empty.astype(np.uint64), empty
    grams = gram_hashes(data, GRAM)
    anchor = sliding_least(grams, LENGTH - GRAM + 1)
    at = np.arange(len(anchor))
    owner = np.searchsorted(offsets, at, "right") - 1
    inside = at + LENGTH <= offsets[owner + 1]
    begins = inside.copy()
    begins[1:] &= (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]) | ~inside[:-1]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return empty, empty, empty, empty.astype(np.uint64), empty
    # a run ends where the next one begins or where windows leave their text
    ends = np.minimum(np.append(starts[1:], len(anchor)), offsets[owner[starts] + 1] - LENGTH + 1)
    again = np.append(False, (grams[:len(anchor) - 1] == anchor[:-1]) & ~begins[1:] & inside[1:])
    times = 1 + np.logical_or.reduceat(again, starts)
    parts = -(-(ends - starts) // LONGEST_PIECE)
    step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = np.repeat(starts, parts) + step * LONGEST_PIECE
    count = np.minimum(LONGEST_PIECE, np.repeat(ends, parts) - begin)
    return owner[begin], begin - offsets[owner[begin]], count, anchor[begin], np.repeat(times, parts)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, text) -> key, anchors, begins, counts, times: lists of each text with at least one window."""
    for whole in batches:
        for batch in W.slices(whole, 1, SLICE):
            data, offsets = W.text_bytes(batch.column(1))
            owner, begin, count, anchor, times = pieces_of(data, offsets)
            ends = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (anchor.view(np.int64), *(y.astype(np.int32) for y in (begin, count, times)))]
            out = pa.RecordBatch.from_arrays([batch.column(0), *lists], ["key", "anchors", "begins", "counts", "times"])
            yield out.filter(pa.array(np.diff(ends) > 0))


# ---- a shard ----------------------------------------------------------------------------------

def suffix_array(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The order of all suffixes of all strings, each up to its string's end (``ends``: of every position).

    Larsson and Sadakane: ``rank`` is the first place of a suffix's group; each round sorts
    the suffixes of groups with more than one by the rank ``width`` bytes further on.
    """
    n = len(data)
    left = ends - np.arange(n)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for i in range(7):  # 7 bytes, then how many of them the string has
        key = (key << np.uint64(8)) | np.where(left > i, padded[i:i + n], 0).astype(np.uint64)
    key = (key << np.uint64(8)) | np.minimum(left, 7).astype(np.uint64)
    order = np.argsort(key, kind="stable").astype(np.int32)
    rank = np.empty(n, np.int32)
    new = np.append(True, key[order[1:]] != key[order[:-1]])
    del key
    first = np.flatnonzero(new)
    rank[order] = np.repeat(first, np.diff(np.append(first, n)))
    open_ = np.flatnonzero(~(new & np.append(new[1:], True)))  # places in groups of more than one
    width = 7
    while len(open_):
        at = order[open_]
        onward = at + width
        past = onward >= ends[at]
        # a suffix that ends here precedes the longer ones; equal ends keep the order of their strings
        second = np.where(past, at.astype(np.int64) - n, rank[np.minimum(onward, n - 1)])
        key = rank[at].astype(np.int64) * (2 * n + 1) + (second + n)
        by = np.argsort(key, kind="stable")
        order[open_], key = at[by], key[by]
        new = np.append(True, key[1:] != key[:-1])
        first = np.flatnonzero(new)
        rank[order[open_]] = open_[np.repeat(first, np.diff(np.append(first, len(open_))))]
        open_ = open_[~(new & np.append(new[1:], True))]
        width *= 2
    return order


def common_prefixes(data: np.ndarray, ends: np.ndarray, begins: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For every position the bytes that its suffix shares with the preceding one in ``order``.

    Kasai: from one position to the next in a string at most one byte is lost.  The strings
    are scanned in step, position by position.
    """
    n = len(data)
    before = np.full(n, -1, np.int32)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int32)
    lengths = ends[begins] - begins
    alive, step = np.arange(len(begins)), 0
    known = np.zeros(len(begins), np.int64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded.view(np.uint8), (n, 8), (1, 1)).copy().view("<u8")[:, 0]  # the 8 bytes from each position
    while len(alive):
        p = begins[alive] + step
        q = before[p].astype(np.int64)
        l = np.maximum(known[alive] - 1, 0)  # noqa: E741
        l[q < 0] = 0
        room = np.minimum(ends[p] - p, np.where(q >= 0, ends[q] - q, 0))
        at = np.flatnonzero(l < room)
        while len(at):
            differ = eight[p[at] + l[at]] ^ eight[q[at] + l[at]]
            lowest = (differ & (~differ + np.uint64(1))).astype(np.float64)  # a power of two: 8 bits for each equal byte
            equal = np.where(differ == 0, 8, (np.frexp(lowest)[1] - 1) // 8)
            l[at] = np.minimum(l[at] + equal, room[at])
            at = at[(equal == 8) & (l[at] < room[at])]
        shared[p], known[alive] = l, l
        step += 1
        alive = alive[lengths[alive] > step]
    return shared


def repeated_windows(strings: list[bytes]) -> list[np.ndarray]:
    """For each of the different ``strings`` which of its windows start anywhere else in them too."""
    lengths = np.array([len(s) for s in strings], np.int64)
    data = np.frombuffer(b"".join(strings), np.uint8)
    stops = np.cumsum(lengths)
    begins = stops - lengths
    ends = np.repeat(stops, lengths)
    order = suffix_array(data, ends)
    shared = common_prefixes(data, ends, begins, order)
    found = shared >= LENGTH
    # a suffix is repeated too if the following one shares enough with it
    follow = order[1:][found[order[1:]]]
    place = np.empty(len(data), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    found[order[place[follow] - 1]] = True
    return [found[b:b + n - LENGTH + 1] for b, n in zip(begins, lengths, strict=True)]


def window_prints(text: bytes) -> np.ndarray:
    """128 bits for every window of ``text``."""
    data = np.frombuffer(text, np.uint8)
    out = np.empty(len(data) - LENGTH + 1, [("high", "<u8"), ("low", "<u8")])
    out["high"], out["low"] = gram_hashes(data, LENGTH), gram_hashes(data, LENGTH, 0x9E3779B97F4A7C15)
    return out


def runs(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], marks, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]


_FOUND = "key binary, start int, stop int, part int, shard int, prints binary, sure binary, starts binary, owners binary, keys array<binary>"
_PRINT = np.dtype([("high", "<u8"), ("low", "<u8")])


def _search(most: int, parts: int):
    """See ``_search_shard``."""
    return lambda table: _search_shard(table, most, parts)


def _search_shard(table: pa.Table, most: int, parts: int) -> pa.Table:
    """The pieces of one shard (key, begin, n, shard, piece) -> spans that go, and runs of windows to merge.

    A row with ``start`` is a span of a text's bytes (``stop`` its end).  A row with ``prints`` is a sorted run:
    the fingerprints, in one of ``parts`` parts, of the windows of pieces whose anchor occurs more than ``most``
    times, with each window's place and whether it is repeated here already.  Equal windows give one row, so a
    passage that stands in any number of texts meets in ``_merge`` as often as there are shards.
    """
    table = table.combine_chunks()
    number: dict[bytes, int] = {}
    text_of = np.array([number.setdefault(x.as_buffer().to_pybytes(), len(number)) for x in table.column("piece").chunk(0)], np.int64)
    marks = repeated_windows(list(number))
    keys, begin, hot = table.column("key").chunk(0), np.asarray(table.column("begin")).astype(np.int64), np.asarray(table.column("n")) > most
    copies = np.bincount(text_of)
    empty = np.zeros(0, np.int64)
    rows, places, stops = [empty], [empty], [empty]
    for row, i in enumerate(text_of.tolist()):
        first, last = runs(np.ones(len(marks[i]), bool) if copies[i] > 1 else marks[i])
        rows.append(np.full(len(first), row))
        places.append(begin[row] + first)
        stops.append(begin[row] + last - 1 + LENGTH)
    rows = np.concatenate(rows)
    spans = pa.table({"key": keys.take(pa.array(rows)), "start": pa.array(np.concatenate(places), pa.int32()), "stop": pa.array(np.concatenate(stops), pa.int32())})

    _, samples = np.unique(text_of, return_index=True)  # a row for each different piece
    samples = samples[hot[samples]]
    texts = list(number)
    prints, sure, starts, owners = [np.zeros(0, _PRINT)], [np.zeros(0, bool)], [empty], [empty]
    for row in samples.tolist():
        i = text_of[row]
        prints.append(window_prints(texts[i]))
        sure.append(np.ones(len(marks[i]), bool) if copies[i] > 1 else marks[i])
        starts.append(np.arange(len(marks[i])) + begin[row])
        owners.append(np.full(len(marks[i]), row))
    prints, sure, starts, owners = (np.concatenate(x) for x in (prints, sure, starts, owners))
    order = np.lexsort((prints["low"], prints["high"]))
    # of windows that are equal here, all sure already, one tells the other shards
    new = np.append(True, prints[order][1:] != prints[order][:-1])[:len(order)]
    order = order[new | ~sure[order]]
    part = (prints["low"][order] % np.uint64(parts)).astype(np.int64)
    out = []
    for p in np.unique(part).tolist():
        own = order[part == p]
        names, place = np.unique(owners[own], return_inverse=True)
        out.append({"part": p, "shard": table.column("shard")[0].as_py(), "prints": prints[own].tobytes(), "sure": sure[own].tobytes(),
                    "starts": starts[own].astype("<i4").tobytes(), "owners": place.astype("<i4").tobytes(), "keys": keys.take(pa.array(names)).to_pylist()})
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4, pa.list_(pa.binary())]
    fields = [f.split()[0] for f in _FOUND.split(", ")]
    run_rows = pa.table({f: pa.array([r[f] for r in out], k) for f, k in zip(fields[3:], kinds, strict=True)})
    return pa.concat_tables([spans, run_rows], promote_options="default").select(fields)


def _merge(table: pa.Table) -> pa.Table:
    """The runs of all shards for one part -> spans of the windows that another shard has too.

    The runs are merged to one sorted array; where a window's fingerprint begins and ends in it
    is found by binary search, and more than one shard between the two makes the window a repeat.
    """
    rows = table.select(["shard", "prints", "sure", "starts", "owners", "keys"]).to_pylist()
    lengths = [len(r["sure"]) for r in rows]
    whole = np.concatenate([np.frombuffer(r["prints"], _PRINT) for r in rows])
    shard = np.repeat([r["shard"] for r in rows], lengths)
    row_of = np.repeat(np.arange(len(rows)), lengths)
    sure, starts, owners = (np.concatenate([np.frombuffer(r[c], t) for r in rows]) for c, t in (("sure", bool), ("starts", "<i4"), ("owners", "<i4")))
    order = np.lexsort((shard, whole["low"], whole["high"]))
    high = whole["high"][order]
    new = np.append(True, (high[1:] != high[:-1]) | (whole["low"][order][1:] != whole["low"][order][:-1]))
    begins = np.flatnonzero(new)
    at = np.arange(len(order))
    first = begins[np.searchsorted(begins, at, "right") - 1]
    last = np.append(begins[1:], len(order))[np.searchsorted(begins, at, "right") - 1] - 1
    several = shard[order[first]] != shard[order[last]]
    keep = order[several & ~sure[order]]
    keys = [rows[r]["keys"][o] for r, o in zip(row_of[keep].tolist(), owners[keep].tolist(), strict=True)]
    return pa.table({"key": pa.array(keys, pa.binary()), "start": pa.array(starts[keep], pa.int32()), "stop": pa.array(starts[keep] + LENGTH, pa.int32())})


# ---- cutting ----------------------------------------------------------------------------------------

def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, text, spans) -> key, n_removed, n_spans, kept: the text without the spans' bytes."""
    for batch in batches:
        removed, n, kept = [], [], []
        for text, spans in zip(batch.column(1), batch.column(2), strict=True):
            raw = text.as_buffer().to_pybytes()
            gone = np.zeros(len(raw) + 1, np.int32)
            values = spans.values
            np.add.at(gone, np.asarray(values.field("start")), 1)
            np.add.at(gone, np.asarray(values.field("stop")), -1)
            mask = np.cumsum(gone[:-1]) > 0
            removed.append(int(mask.sum()))
            n.append(len(runs(mask)[0]))
            kept.append(np.frombuffer(raw, np.uint8)[~mask].tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(removed, pa.int64()), pa.array(n, pa.int64()), pa.array(kept, pa.binary())],
                                         ["key", "n_removed", "n_spans", "kept"])


def text_key(body: Column) -> Column:
    return F.unhex(F.md5(body))


def cut_texts(docs: DataFrame, text: str = "text", most: int = HOT) -> DataFrame:
    """``key, n_removed, n_spans, kept`` of the texts that lose bytes; ``key``: the text's ``text_key``."""
    ship(docs.sparkSession)
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    texts = docs.select(body.alias("text")).where(F.length("text") >= LENGTH).withColumn("key", text_key(F.col("text")))
    anchored = texts.select("key", "text").mapInArrow(_anchors, "key binary, anchors array<bigint>, begins array<int>, counts array<int>, times array<int>")
    lists = ("anchors", "begins", "counts", "times")
    classes = pin(anchored.groupBy("key").agg(*[F.first(c).alias(c) for c in lists]), "anchors")
    pieces = classes.select("key", F.explode(F.arrays_zip(*lists)).alias("p")).select(
        "key", F.col("p.anchors").alias("anchor"), F.col("p.begins").alias("begin"), F.col("p.counts").alias("windows"), F.col("p.times").alias("times"))
    shared = pin(pieces.groupBy("anchor").agg(F.sum("times").alias("n")).where("n > 1"), "shared-anchors")
    alive = pin(pieces.drop("times").join(shared, "anchor"), "alive-pieces")
    size, hot = alive.agg(F.sum(F.col("windows") + LENGTH - 1), F.sum(F.when(F.col("n") > most, F.col("windows")))).first()
    shards, parts = 1 + (size or 0) // SHARD_BYTES, 1 + (hot or 0) // MERGE_ROWS

    wanted = alive.select("key").distinct()
    once = pin(texts.join(wanted, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text")), "cut-candidates")
    part = F.pmod(F.xxhash64("key", "begin"), F.ceil(F.col("n") / most))
    dealt = alive.join(once, "key").select(
        "key", "begin", "n", F.pmod(F.xxhash64("anchor", part), F.lit(shards)).cast("int").alias("shard"),
        F.expr(f"substring(text, begin + 1, windows + {LENGTH - 1})").alias("piece"))
    found = pin(dealt.groupBy("shard").applyInArrow(_search(most, parts), _FOUND), "found")
    merged = (found.where("prints is not null").groupBy("part").applyInArrow(_merge, "key binary, start int, stop int"))
    spans = found.where("stop is not null").select("key", "start", "stop").union(merged)
    spans = spans.groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return once.join(spans, "key").select("key", "text", "spans").mapInArrow(_cut, "key binary, n_removed long, n_spans long, kept binary")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row."""
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    sized = pin(docs.select(F.col(doc_id).alias("doc_id"), text_key(body).alias("key"), F.length(body).cast("long").alias("n_bytes"),
                            F.sha2(body, 256).alias("whole_sha256")), "sized")
    copied = sized.where(F.col("n_bytes") >= LENGTH).groupBy("key").agg(F.count("*").alias("copies")).where("copies > 1").drop("copies")
    cut = cut_texts(docs, text, most).select("key", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    changed = pin(cut.join(copied.withColumn("copied", F.lit(True)), "key", "full"), "changed")
    out = sized.join(changed, "key", "left")
    whole = F.coalesce(F.col("copied"), F.lit(False))
    return out.select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"))

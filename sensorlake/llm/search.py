"""Exact BM25 top-k search by block-max pruning of sharded inverted indexes (operator 9).

Documents are dealt to shards of about ``SHARD_BYTES`` of text.  A shard's inverted index lists
each term's documents in order; the lists are cut at every ``BLOCK`` documents, and a block of a
list knows its largest impact.  For a query, the block maxima of its terms add up to a bound for
every block of documents.  Blocks are scored in falling order of their bounds, and as soon as no
bound reaches the k-th best score the rest is skipped, as WAND skips what lies before its pivot.
Nothing that could rank is skipped, so a shard's answer is exact.  A query whose lists have
more than ``DENSE`` entries for each document leaves bounds little to skip, and they would cost more
than they spare: its lists are added up in one pass.

Terms that stand in more than ``COMMON`` of a shard's documents have no list: their impacts are
rows of a matrix, which gives their exact part of all scores of ``TOGETHER`` queries in one product,
and this part's maxima, in place of those of each term, enter the bounds.

Queries are written in groups of ``GROUP_TERMS`` words, and a task pairs index rows with groups as
both are read (a product without a shuffle), so no copies of queries or shards come to any disk.

Document frequencies, the number of documents and their mean length are those of the whole corpus,
so scores of different shards compare and the best k of all shards are the best k.

A query's words count once.  Scores are rounded to ``DIGITS`` decimals and ties go to the smaller
id.  Words are those of ``words`` (lower-cased A-Z, cut at white space), by their 64-bit hashes.

Defined results: documents with a null id take no part; a document without words is found by no
query, and asks for nothing; only documents that share a word with the query are answers, and none
with the query's own id; repeated rows are answers of their own, a repeated query id is asked once,
with the least of its texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.llm import words as W
from sensorlake.llm.scratch import partitions, pin
from sensorlake.llm.ship import ship

K1, B = 1.2, 0.75
BLOCK = 128
SHARD_BYTES = 32 << 20
COMMON = 1 / 16  # of a shard's documents
TOGETHER = 64  # queries
DENSE = 1 / 8  # list entries of a query for each document of a shard
GROUP_TERMS = 1 << 20  # words of all queries in a row; a query counts as QUERY_TERMS words more
QUERY_TERMS = 64
STRIPE = 16 * BLOCK  # columns of the matrix of which the rows that are used are copied
DIGITS = 6
SLICE = 1 << 20


# ---- terms ----------------------------------------------------------------------------------

def term_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(owner, term, times) of the different terms of all texts, sorted, and the texts' lengths in words."""
    hashes, ends = W.word_hashes(data, offsets)
    owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    first = np.flatnonzero(new)
    return o[first], h[first], np.diff(np.append(first, len(h))), np.diff(ends)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) -> term, documents, words: partial sums; the row without a term counts documents and words."""
    docs, length = 0, 0
    terms, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def rows() -> pa.RecordBatch:
        t = pa.array(np.append(terms.view(np.int64), 0), mask=np.append(np.zeros(len(terms), bool), True))
        return pa.RecordBatch.from_arrays([t, pa.array(np.append(counts, docs)), pa.array(np.append(np.zeros(len(terms), np.int64), length))], ["term", "documents", "words"])

    for whole in batches:
        for batch in W.slices(whole, 0, SLICE):
            _, h, _, lengths = term_counts(*W.text_bytes(batch.column(0)))
            docs, length = docs + len(lengths), length + int(lengths.sum())
            own, times = np.unique(h, return_counts=True)
            every = np.concatenate([terms, own])
            terms, place = np.unique(every, return_inverse=True)
            counts = np.bincount(place, np.concatenate([counts, times]), len(terms)).astype(np.int64)
            if len(terms) > 500_000:
                yield rows()
                docs, length, terms, counts = 0, 0, terms[:0], counts[:0]
    yield rows()


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(query_id, text) -> query_id, term."""
    for whole in batches:
        for batch in W.slices(whole, 1, SLICE):
            owner, h, _, _ = term_counts(*W.text_bytes(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), pa.array(h.view(np.int64))], ["query_id", "term"])


_GROUP = "queries binary, starts binary, places binary, words binary, idf binary"


def _group(ids: list[np.ndarray], lengths: list[np.ndarray], terms: list[np.ndarray], idf: list[np.ndarray]) -> pa.RecordBatch:
    """One row: queries, where each one's words begin, the words as places among all different ones, and these with their idf."""
    ids, lengths, terms = np.concatenate(ids), np.concatenate(lengths), np.concatenate(terms)
    every, first, places = np.unique(terms, return_index=True, return_inverse=True)
    idf = np.concatenate(idf)[first]
    begins = np.append(0, np.cumsum(lengths))
    # queries that share common words stand together, so that fewer rows of a shard's matrix enter a product
    common = np.flatnonzero(idf < np.log1p(1 / COMMON - 1))
    column = np.full(len(every), -1)
    column[common[np.argsort(idf[common], kind="stable")]] = np.arange(len(common))
    has = np.zeros((len(ids), len(common)), bool)
    at = column[places]
    has[np.repeat(np.arange(len(ids)), lengths)[at >= 0], at[at >= 0]] = True
    order = np.lexsort((ids, *np.packbits(has, axis=1).T[::-1]))
    row = [ids[order].astype("<i8"), np.append(0, np.cumsum(lengths[order])).astype("<i4"),
           places[_spread(begins[order], begins[order + 1])].astype("<i4"), every.astype("<u8"), idf.astype("<f8")]
    return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in row], [f.split()[0] for f in _GROUP.split(", ")])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(query_id, words) -> rows of ``_GROUP`` with about ``GROUP_TERMS`` words each; a longer single query stays whole."""
    held, size = [], 0
    for batch in batches:
        ids, lists = np.asarray(batch.column(0)), batch.column(1)
        lengths, words = np.asarray(lists.value_lengths()), lists.flatten()
        terms, idf = np.asarray(words.field("term")).view(np.uint64), np.asarray(words.field("idf"))
        ends = np.append(0, np.cumsum(lengths, dtype=np.int64))
        sizes = ends + QUERY_TERMS * np.arange(len(ends))
        at = 0
        while at < len(ids):
            stop = max(int(np.searchsorted(sizes, sizes[at] + GROUP_TERMS - size, "right")) - 1, at if held else at + 1)
            if stop > at:
                own = slice(ends[at], ends[stop])
                held.append((ids[at:stop].copy(), lengths[at:stop].copy(), terms[own].copy(), idf[own].copy()))
                size += int(sizes[stop] - sizes[at])
            if stop < len(ids):
                yield _group(*zip(*held, strict=True))
                held, size = [], 0
            at = stop
    if held:
        yield _group(*zip(*held, strict=True))


# ---- index ------------------------------------------------------------------------------------

_INDEX = "shard int, ids binary, lengths binary, terms binary, begins binary, docs binary, times binary"


def _build(table: pa.Table) -> pa.Table:
    """All rows (shard, doc_id, text) of a shard -> one index row; documents in order of length, then id."""
    ids = np.asarray(table.column("doc_id"))
    shard = table.column("shard")[0].as_py()
    owners, terms, times, lengths, done = [], [], [], [], 0
    for whole in table.to_batches():
        for batch in W.slices(whole, 2, SLICE):
            o, h, t, n = term_counts(*W.text_bytes(batch.column(2)))
            owners.append((o + done).astype(np.int32))
            terms.append(h)
            times.append(t.astype(np.int32))
            lengths.append(n)
            done += batch.num_rows
    del table
    lengths = np.concatenate(lengths)
    by = np.lexsort((ids, lengths))
    place = np.empty(len(by), np.int32)
    place[by] = np.arange(len(by), dtype=np.int32)
    # one after the other, as each list and each copy is as large as the shard's text
    docs = np.concatenate(owners)
    del owners
    docs = place[docs]
    terms = np.concatenate(terms)
    order = np.lexsort((docs, terms))
    docs = docs[order]
    terms = terms[order]
    times = np.concatenate(times)[order]
    del order
    begins = np.flatnonzero(np.append(True, terms[1:] != terms[:-1])) if len(terms) else np.zeros(0, np.int64)
    row = [shard, ids[by].astype("<i8").tobytes(), lengths[by].astype("<i4").tobytes(), terms[begins].astype("<u8").tobytes(),
           np.append(begins, len(terms)).astype("<i4").tobytes(), _narrow(docs), _narrow(times)]
    return pa.table({f.split()[0]: pa.array([v], pa.int32() if f.endswith("int") else pa.binary()) for f, v in zip(_INDEX.split(", "), row, strict=True)})


_WIDTHS = (np.dtype("u1"), np.dtype("<u2"), np.dtype("<u4"))


def _narrow(x: np.ndarray) -> bytes:
    """The numbers in the fewest bytes that hold them all; the first byte tells how many."""
    kind = next(k for k, w in enumerate(_WIDTHS) if not len(x) or x.max() <= np.iinfo(w).max)
    return bytes([kind]) + x.astype(_WIDTHS[kind]).tobytes()


def _wide(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, _WIDTHS[raw[0]], offset=1).copy()  # at an even address, where reading is faster


def _spread(begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    n = ends - begins
    out = np.repeat(begins - (np.cumsum(n, dtype=np.int64) - n), n)
    out += np.arange(len(out))
    return out


class Shard:
    """An index row with block maxima and the matrix of common terms, ready to search."""

    def __init__(self, row: dict, mean_length: float):
        self.ids, lengths = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["lengths"], "<i4")
        self.terms, self.begins = np.frombuffer(row["terms"], "<u8"), np.frombuffer(row["begins"], "<i4").astype(np.int64)
        self.docs, times = _wide(row["docs"]), _wide(row["times"])
        norm = K1 * (1 - B + B * lengths / mean_length)
        self.impact = np.empty(len(times))
        for i in range(0, len(times), 1 << 18):  # in pieces, for small temporary arrays
            t = times[i:i + (1 << 18)].astype(float)
            self.impact[i:i + (1 << 18)] = t * (K1 + 1) / (t + norm[self.docs[i:i + (1 << 18)]])
        self.blocks = -(-len(self.ids) // BLOCK)
        counts = np.diff(self.begins)
        common = np.flatnonzero(counts > COMMON * len(self.ids)) if len(self.terms) else np.zeros(0, np.int64)
        self.row_of = np.full(len(self.terms), -1, np.int32)
        self.row_of[common] = np.arange(len(common))
        self.matrix = np.zeros((len(common), self.blocks * BLOCK))
        for i, t in enumerate(common.tolist()):
            own = slice(self.begins[t], self.begins[t + 1])
            self.matrix[i, self.docs[own]] = self.impact[own]
        self.scored = 0  # blocks, over all queries

    @cached_property
    def parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Begins, blocks and bounds of all parts, and where each term's begin; a part is what one term has in one block of documents."""
        new = np.append(True, self.docs[1:] // BLOCK != self.docs[:-1] // BLOCK) if len(self.docs) else np.zeros(0, bool)
        new[self.begins[:-1]] = True
        begin = np.append(np.flatnonzero(new), len(self.docs)).astype(np.int32)
        block = (self.docs[begin[:-1]] // BLOCK).astype(np.int32)
        most = np.maximum.reduceat(self.impact, begin[:-1]) if len(self.docs) else np.zeros(0)
        # rounded up, so still a bound
        most = np.nextafter(most.astype(np.float32), np.float32(np.inf))
        return begin, block, most, np.searchsorted(begin[:-1], self.begins).astype(np.int32)

    def place(self, terms: np.ndarray) -> np.ndarray:
        """Where ``terms``, in ascending order, stand in the index; -1 for those that no document has."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def top(self, queries: list[tuple[int, np.ndarray, np.ndarray]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and scores of the best ``k`` documents for each query (own id, terms in ascending order, their idf)."""
        return self.best([(own, self.place(terms), idf) for own, terms, idf in queries], k)

    def best(self, queries: list[tuple[int, np.ndarray, np.ndarray]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """As ``top``, for terms as ``place`` has them."""
        weights, rare = np.zeros((len(queries), len(self.matrix))), []
        for i, (_, at, idf) in enumerate(queries):
            known = at >= 0
            at, idf = at[known], idf[known]
            rows = self.row_of[at]
            weights[i, rows[rows >= 0]] = idf[rows >= 0]
            rare.append((at[rows < 0], idf[rows < 0]))
        used = np.flatnonzero(weights.any(0))
        weights = np.ascontiguousarray(weights[:, used])
        base = np.empty((len(queries), self.blocks * BLOCK))
        for i in range(0, base.shape[1], STRIPE):
            np.matmul(weights, self.matrix[used, i:i + STRIPE], out=base[:, i:i + STRIPE])
        out = []
        for (own, _, _), (at, idf), scores in zip(queries, rare, base, strict=True):
            entries = int((self.begins[at + 1] - self.begins[at]).sum())
            out.append((self._all if entries >= DENSE * len(self.ids) else self._best)(own, at, idf, scores, k))
        return out

    def _all(self, own: int, at: np.ndarray, idf: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``_best``, without bounds; ``score`` is added to."""
        begin, end = self.begins[at], self.begins[at + 1]
        posting = _spread(begin, end)
        weight = np.repeat(idf, end - begin)
        weight *= self.impact.take(posting, mode="clip")  # the mode that needs no check beforehand
        score[:len(self.ids)] += np.bincount(self.docs.take(posting, mode="clip"), weight, len(self.ids))
        score[np.flatnonzero(self.ids == own)] = 0
        # each of k blocks has a document with its maximum, so the k-th largest maximum is no more than the k-th best score
        most = score.reshape(-1, BLOCK).max(1)
        least = np.partition(most, -k)[-k] - 10.0 ** -DIGITS if len(most) >= k else 0.0
        docs = np.flatnonzero((score >= least) & (score > 0))
        self.scored += self.blocks
        ids, scores = self.ids[docs], np.round(score[docs], DIGITS)
        best = np.lexsort((ids, -scores))[:k]
        return ids[best], scores[best]

    def _best(self, own: int, at: np.ndarray, idf: np.ndarray, base: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """``base``: the common terms' part of every document's score."""
        part_begin, part_block, part_most, term_parts = self.parts
        first, last = term_parts[at], term_parts[at + 1]
        parts = _spread(first, last)
        weight = np.repeat(idf, last - first)
        block = part_block[parts]
        bound = np.bincount(block, weight * part_most[parts], self.blocks) + base.reshape(-1, BLOCK).max(1)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        score = base[:len(self.ids)]
        ids, scores, done, step, least = self.ids[:0], np.zeros(0), 0, 32, -1.0
        while done < len(order) and bound[order[done]] >= least:
            now = order[done:done + step]
            done, step = done + step, step * 4
            chosen = np.zeros(self.blocks, bool)
            chosen[now] = True
            own_parts = chosen[block]
            begin, end = part_begin[parts[own_parts]], part_begin[parts[own_parts] + 1]
            posting = _spread(begin, end)
            more = np.bincount(self.docs[posting], np.repeat(weight[own_parts], end - begin) * self.impact[posting], len(self.ids))
            docs = (now[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            docs = docs[docs < len(self.ids)]
            total = score[docs] + more[docs]
            docs, total = docs[total > max(least, 0)], total[total > max(least, 0)]
            other = self.ids[docs] != own
            ids, scores = np.concatenate([ids, self.ids[docs[other]]]), np.concatenate([scores, np.round(total[other], DIGITS)])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            if len(ids) == k:
                least = scores[-1] - 10.0 ** -DIGITS  # what rounds to the k-th score may still tie
        self.scored += min(done, len(order))
        return ids, scores


_INDEX_NAMES, _GROUP_NAMES = ([f.split()[0] for f in kind.split(", ")] for kind in (_INDEX, _GROUP))


def _search(k: int, mean_length: float):
    """Rows of an index row and a group of queries each -> the best ``k`` documents of each query in each shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                if shard is None or batch.column("shard")[i].as_py() != number:
                    shard, number = None, None  # before the next one is opened
                    row = batch.select(_INDEX_NAMES).slice(i, 1).to_pylist()[0]
                    shard, number = Shard(row, mean_length), row["shard"]
                    del row
                own, starts, places, words, idf = (np.frombuffer(batch.column(c)[i].as_buffer(), kind)
                                                   for c, kind in zip(_GROUP_NAMES, ("<i8", "<i4", "<i4", "<u8", "<f8"), strict=True))
                at = shard.place(words)
                ids, docs, scores = [], [], []
                for first in range(0, len(own), TOGETHER):
                    some = []
                    for q in range(first, min(first + TOGETHER, len(own))):
                        mine = places[starts[q]:starts[q + 1]]
                        some.append((int(own[q]), at[mine], idf[mine]))
                    found = shard.best(some, k)
                    ids.append(np.repeat([q for q, _, _ in some], [len(d) for d, _ in found]))
                    docs += [d for d, _ in found]
                    scores += [s for _, s in found]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), kind) for x, kind in ((ids, pa.int64()), (docs, pa.int64()), (scores, pa.float64()))], ["query_id", "doc_id", "score"])

    return run


# ---- interface ------------------------------------------------------------------------------------

class Index:
    """The written index of a corpus with its global statistics."""

    def __init__(self, shards: DataFrame, count: int, documents: int, mean_length: float, frequencies: DataFrame):
        self.shards, self.count, self.documents, self.mean_length, self.frequencies = shards, count, documents, mean_length, frequencies

    @staticmethod
    def build(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Index:
        ship(docs.sparkSession)
        body = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).where("doc_id is not null")
        partial = body.select("text").mapInArrow(_frequencies, "term long, documents long, words long")
        sums = pin(partial.groupBy("term").agg(F.sum("documents").alias("documents"), F.sum("words").alias("words")), "frequencies")
        whole = sums.where("term is null").first()
        documents, length = (whole["documents"], whole["words"]) if whole else (0, 0)
        size = body.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        count = 1 + size // SHARD_BYTES
        # rows that share an id are dealt by their texts too
        dealt = body.select(F.pmod(F.xxhash64("doc_id", F.substring("text", -64, 64)), F.lit(count)).cast("int").alias("shard"), "doc_id", "text")
        dealt = dealt.repartition(partitions(docs.sparkSession, count), "shard")
        shards = pin(dealt.groupBy("shard").applyInArrow(_build, _INDEX), "bm25-index", rows_per_file=1)  # a file is what a task of the search reads
        return Index(shards, count, documents, length / documents if length else 1.0, sums.where("term is not null").select("term", "documents"))

    def search(self, queries: DataFrame, k: int = 10, query_id: str = "doc_id", text: str = "text") -> DataFrame:
        """``query_id, rank, doc_id, score``: the best ``k`` documents for the words of each whole text of ``queries``."""
        asked = queries.select(F.col(query_id).cast("long").alias("query_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).where("query_id is not null")
        asked = asked.groupBy("query_id").agg(F.min("text").alias("text")).select("query_id", "text")
        terms = asked.mapInArrow(_query_terms, "query_id long, term long").join(self.frequencies, "term")
        n = F.lit(float(self.documents))
        idf = F.log1p((n - F.col("documents") + 0.5) / (F.col("documents") + 0.5))
        # the order of the terms, by their unsigned hashes, is the order in which scores are added up
        unsigned = F.struct((F.col("term") < 0).alias("high"), "term", idf.alias("idf"))
        words = pin(terms.groupBy("query_id").agg(F.array_sort(F.collect_list(unsigned)).alias("words")), "query-words")
        words = words.select("query_id", F.transform("words", lambda w: F.struct(w["term"].alias("term"), w["idf"].alias("idf"))).alias("words"))
        size = words.agg(F.sum(F.size("words") + QUERY_TERMS)).first()[0] or 0
        groups = pin(words.coalesce(1 + size // GROUP_TERMS).mapInArrow(_groups, _GROUP), "query-groups", rows_per_file=1)
        # a pair is a task of its own unless the cluster has far fewer tasks: rows of many pairs would fill an Arrow batch
        tasks = 1 + 16 * int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions")) // (1 + size // GROUP_TERMS)
        work = self.shards.coalesce(tasks).hint("shuffle_replicate_nl").crossJoin(groups)
        found = work.mapInArrow(_search(k, self.mean_length), "query_id long, doc_id long, score double")
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")

"""Approximate nearest neighbours by robust-pruned directed graphs (operator 1).

Rows are dealt to shards of about ``SHARD_ROWS`` by the hash of their id.  In a shard equal
vectors are one node.  The graph starts at random; then every node, in batches, is looked up
by a greedy beam search from the medoid, the nodes met are its candidates, and pruning keeps
a candidate only if no kept one is nearer to it than the node is, by the factor ``ALPHA``
(the first round uses 1).  Kept edges are also entered backwards, and lists that overflow are
pruned again.  All searches of a batch take their steps together, in numpy.

Every query runs a beam search in every shard; the nodes it ends with are ranked by the exact
distance in double precision on the original vectors, and the shards' answers are merged.  An
index row and the queries for its shard stream through one task, so memory holds one shard and
one batch of queries.

Defined results: vectors that are null, zero, or hold null or non-finite numbers take no part;
vectors meet those of their own length only; a repeated query id is searched once, with the
least of its vectors, and no row with the query's id is an answer; ties go to the smaller id;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.llm.scratch import partitions
from sensorlake.llm.ship import ship

SHARD_ROWS = 4096
DEGREE, SLACK = 32, 16
BEAM, ALPHA = 64, 1.2
QUERY_BEAM = 96
BATCH = 256
EXPAND = 4
SEEDS = 8


# ---- the graph ----------------------------------------------------------------------------

class Graph:
    """Nodes (float32 vectors) with up to DEGREE + SLACK outgoing edges; -1 fills the rest."""

    def __init__(self, vectors: np.ndarray, edges: np.ndarray | None = None):
        n = len(vectors)
        # one more row stands for "no node": -1 among the edges points to it
        self.vectors = np.vstack([vectors, np.zeros((1, vectors.shape[1]))]).astype(np.float32)
        self.norms = (self.vectors ** 2).sum(1)
        rng = np.random.default_rng(n)
        medoid = int(((self.vectors[:n] - self.vectors[:n].mean(0)) ** 2).sum(1).argmin()) if n else 0
        self.starts = np.unique(np.append(rng.integers(0, max(n, 1), min(SEEDS, n)), medoid)) if n else np.zeros(0, np.int64)
        if edges is None:
            edges = np.full((n, DEGREE + SLACK), -1, np.int32)
            if n > 1:
                random = rng.integers(0, n - 1, (n, min(DEGREE // 2, n - 1)))
                edges[:, :random.shape[1]] = random + (random >= np.arange(n)[:, None])
        self.edges = edges

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest nodes met (ids, -1 for none, and squared distances), nearest first."""
        q, n = len(queries), len(self.edges)
        rows = np.arange(q)[:, None]
        seen = np.zeros((q, n + 1), bool)
        seen[:, n] = True
        order = np.zeros((q, n + 1), np.int32)
        ids = np.full((q, beam), -1, np.int64)
        dist = np.full((q, beam), np.inf, np.float32)
        done = np.zeros((q, beam), bool)
        new = np.broadcast_to(self.starts, (q, len(self.starts)))
        active = np.arange(q)
        while len(active):
            r = rows[:len(active)]
            own = active[:, None]
            place = np.arange(new.shape[1])
            order[own, new] = place
            fresh = ~seen[own, new] & (order[own, new] == place)
            seen[own, new] = True
            d = self.norms[new] - 2 * np.einsum("qd,qkd->qk", queries[active], self.vectors[new], optimize=True)
            d = np.where(fresh, d, np.inf).astype(np.float32)
            every_d = np.concatenate([dist[active], d], 1)
            every_id = np.concatenate([ids[active], new], 1)
            every_done = np.concatenate([done[active], ~fresh], 1)
            best = np.argpartition(every_d, beam - 1, axis=1)[:, :beam] if every_d.shape[1] > beam else np.broadcast_to(np.arange(beam), (len(active), beam))
            best = np.take_along_axis(best, np.argsort(every_d[r, best], axis=1, kind="stable"), 1)
            dist[active], ids[active], done[active] = every_d[r, best], every_id[r, best], every_done[r, best]
            todo = ~done[active] & np.isfinite(dist[active])
            more = todo.any(1)
            active, todo = active[more], todo[more]
            if not len(active):
                break
            first = np.argsort(~todo, axis=1, kind="stable")[:, :EXPAND]
            real = np.take_along_axis(todo, first, 1)
            done[active[:, None], first] |= real
            expanded = np.where(real, ids[active[:, None], first], -1)
            new = np.where(expanded[:, :, None] >= 0, self.edges[expanded], -1).reshape(len(active), -1).astype(np.int64)
            new[new < 0] = n
        ids[~np.isfinite(dist)] = -1
        return ids, dist + (queries ** 2).sum(1)[:, None]

    def prune(self, nodes: np.ndarray, candidates: np.ndarray, alpha: float) -> np.ndarray:
        """Up to DEGREE diverse neighbours of each node from its candidates (-1: none)."""
        out = np.full((len(nodes), DEGREE), -1, np.int32)
        candidates = np.sort(candidates, 1)
        none = (candidates < 0) | (candidates == nodes[:, None])
        none[:, 1:] |= candidates[:, 1:] == candidates[:, :-1]
        c = np.where(none, 0, candidates)
        v, p = self.vectors[c], self.vectors[nodes]
        far = self.norms[c] + self.norms[nodes][:, None] - 2 * np.einsum("bd,bkd->bk", p, v, optimize=True)
        far = np.where(none, np.inf, far)
        by = np.argsort(far, 1, kind="stable")
        far, c = np.take_along_axis(far, by, 1), np.take_along_axis(c, by, 1)
        v = self.vectors[c]
        between = self.norms[c][:, :, None] + self.norms[c][:, None, :] - 2 * np.matmul(v, v.transpose(0, 2, 1))
        alive = np.isfinite(far)
        rows = np.arange(len(nodes))
        for k in range(DEGREE):
            best = alive.argmax(1)
            some = alive[rows, best]
            if not some.any():
                break
            out[some, k] = c[rows, best][some]
            alive &= ~((alpha * alpha * between[rows, best] <= far) & some[:, None])
            alive[rows, best] = False
        return out

    def insert(self, nodes: np.ndarray, alpha: float) -> None:
        """Search for the nodes, prune what was met to their neighbours, and enter the edges backwards."""
        met, _ = self.search(self.vectors[nodes], BEAM)
        kept = self.prune(nodes, np.concatenate([met, self.edges[nodes]], 1), alpha)
        self.edges[nodes] = -1
        self.edges[nodes, :DEGREE] = kept
        to, source = kept.ravel(), np.repeat(nodes, DEGREE)
        source, to = source[to >= 0], to[to >= 0]
        by = np.argsort(to, kind="stable")
        source, to = source[by], to[by]
        targets, begin, counts = np.unique(to, return_index=True, return_counts=True)
        groups = np.argsort(counts, kind="stable")  # lists of like length together
        for i in range(0, len(groups), BATCH):
            g = groups[i:i + BATCH]
            new = np.full((len(g), counts[g].max()), -1, np.int64)
            column = np.arange(new.shape[1])
            real = column < counts[g][:, None]
            new[real] = source[(begin[g][:, None] + column)[real]]
            old = self.edges[targets[g]]
            new[(new[:, :, None] == old[:, None, :]).any(2)] = -1
            both = np.concatenate([old, new], 1)
            both = np.take_along_axis(both, np.argsort(both < 0, 1, kind="stable"), 1)
            sizes = (both >= 0).sum(1)
            full = sizes > DEGREE + SLACK
            out = np.full((len(g), DEGREE + SLACK), -1, np.int64)
            width = min(DEGREE + SLACK, both.shape[1])
            out[:, :width] = both[:, :width]
            if full.any():
                out[full] = -1
                out[full, :DEGREE] = self.prune(targets[g][full], both[full], alpha)
            self.edges[targets[g]] = out

    def build(self) -> Graph:
        n = len(self.edges)
        order = np.random.default_rng(n + 1).permutation(n)
        for alpha in (1.0, ALPHA):
            for i in range(0, n, BATCH):
                self.insert(order[i:i + BATCH], alpha)
        return self


# ---- index -----------------------------------------------------------------------------------

_INDEX = "dim int, shard int, ids binary, owners binary, vectors binary, edges binary"


def _build(table: pa.Table) -> pa.Table:
    """All rows (dim, shard, vec_id, vector) of a shard -> one index row."""
    dim, shard = table.column("dim")[0].as_py(), table.column("shard")[0].as_py()
    ids = np.asarray(table.column("vec_id"))
    rows = np.concatenate([np.asarray(c.flatten(), np.float64) for c in table.column("vector").chunks]).reshape(len(ids), dim)
    nodes, owner = np.unique(rows, axis=0, return_inverse=True)
    by = np.lexsort((ids, owner.ravel()))
    graph = Graph(nodes).build()
    row = [dim, shard, ids[by].astype("<i8").tobytes(), owner.ravel()[by].astype("<i4").tobytes(), nodes.astype("<f8").tobytes(), graph.edges.astype("<i4").tobytes()]
    types = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
    return pa.table({f.split()[0]: pa.array([v], t) for f, v, t in zip(_INDEX.split(", "), row, types, strict=True)})


def usable(vector: Column) -> Column:
    """Neither null nor zero, and all numbers finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def vectors_of(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, vector, dim`` of the rows that take part."""
    out = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    return out.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).withColumn("dim", F.size("vector"))


def build_index(vectors: DataFrame, shards: int) -> DataFrame:
    """One row per shard; ``vectors``: rows of ``vec_id, vector, dim``."""
    ship(vectors.sparkSession)
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    # a given number of partitions: shards are few bytes and much work, so they should not be put together by size
    dealt = dealt.select("dim", "shard", "vec_id", "vector").repartition(partitions(vectors.sparkSession, shards), "dim", "shard")
    return dealt.groupBy("dim", "shard").applyInArrow(_build, _INDEX)


class Shard:
    """An index row, ready to search."""

    def __init__(self, row: dict):
        dim = row["dim"]
        self.ids, owners = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["owners"], "<i4")
        self.vectors = np.frombuffer(row["vectors"], "<f8").reshape(-1, dim)
        self.begin = np.searchsorted(owners, np.arange(len(self.vectors) + 1))
        self.graph = Graph(self.vectors, np.frombuffer(row["edges"], "<i4").reshape(len(self.vectors), -1))

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, k: int, beam: int) -> Iterator[tuple[int, int, float]]:
        """(query, id, distance) of the ``k`` nearest rows found for each query, without rows of its own id."""
        met, _ = self.graph.search(queries.astype(np.float32), max(beam, k + 1))
        for own, query, nodes in zip(query_ids.tolist(), queries, met, strict=True):
            nodes = nodes[nodes >= 0]
            score = np.sqrt(((self.vectors[nodes] - query) ** 2).sum(1))
            found = []
            for i in np.argsort(score, kind="stable"):
                if len(found) > k and score[i] > found[k][0]:
                    break
                # of equal rows the k + 1 smallest ids are enough, one of which may be the query's
                some = self.ids[self.begin[nodes[i]]:self.begin[nodes[i] + 1]]
                found += [(float(score[i]), x) for x in some[some != own][:k].tolist()]
                found.sort()
            for s, x in sorted(found)[:k]:
                yield own, x, s


_WORK = "dim int, shard int, kind int, vec_id long, vector array<double>, ids binary, owners binary, vectors binary, edges binary"


def _search(k: int, beam: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, key = None, None
        for batch in batches:
            kinds = np.asarray(batch.column(2))
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            at = 0
            while at < batch.num_rows:
                if kinds[at] == 0:
                    row = batch.slice(at, 1).to_pylist()[0]
                    shard, key = Shard(row), keys[at]
                    at += 1
                    continue
                stop = at
                while stop < batch.num_rows and kinds[stop] == 1 and keys[stop] == keys[at] and stop - at < BATCH:
                    stop += 1
                if key == keys[at]:  # else no row of this length is in the shard
                    part = batch.slice(at, stop - at)
                    queries = np.asarray(part.column(4).flatten(), np.float64).reshape(stop - at, -1)
                    found = list(shard.nearest(np.asarray(part.column(3)), queries, k, beam))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.float64())],
                        ["query_id", "vec_id", "score"])
                at = stop

    return run


def search(index: DataFrame, queries: DataFrame, shards: int, k: int = 10, beam: int = QUERY_BEAM) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each of ``queries`` (``vec_id, vector, dim``)."""
    ship(queries.sparkSession)
    asked = queries.groupBy("vec_id", "dim").agg(F.min("vector").alias("vector"))
    asked = asked.select("dim", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), "vec_id", "vector",
                         *[F.lit(None).cast("binary").alias(c) for c in ("ids", "owners", "vectors", "edges")])
    stored = index.select("dim", "shard", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("vec_id"), F.lit(None).cast("array<double>").alias("vector"),
                          "ids", "owners", "vectors", "edges")
    work = stored.union(asked).repartition(partitions(queries.sparkSession, shards), "dim", "shard").sortWithinPartitions("dim", "shard", "kind")
    found = work.mapInArrow(_search(k, beam), "query_id long, vec_id long, score double")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def shard_count(vectors: DataFrame) -> int:
    return 1 + vectors.count() // SHARD_ROWS

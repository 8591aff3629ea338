"""Sharding by a minimax contiguous partition of ordered atomic groups (operator 5).

Equal texts form an atomic group.  The smallest capacity with which the ordered
groups fit into the wanted number of shards, each shard a contiguous run, is
found by binary search with a greedy check, and the order is cut there.

Order: groups of at least an equal share come first, largest first (at most one
for each shard; each would fill a shard anyway), all others follow in the order
of their text digest, which keeps neighbours independent of size and source.

The group sizes never leave the cluster as a whole.  The driver holds a histogram
over digest prefixes; buckets in which a cut might fall for any capacity still in
question are split by one more hex digit, by a distributed aggregate, until every
such bucket is a single group.  The histogram has a few thousand rows at any
input size, and the result equals a search over all groups.

Defined results: a null text is a group of its own with no bytes and checksum 0;
repeated rows are placed one by one; null ids are placed like others; an empty
table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.running import running_total
from sensorlake.llm.scratch import pin

FIRST_DIGITS = 3


def smallest_capacity(edges: list[int], shards: int, least: int = 0) -> int:
    """The smallest capacity with which greedy packing needs at most ``shards`` runs; ``edges``: running sums from 0."""
    low = max([least, -(-edges[-1] // shards), *(b - a for a, b in zip(edges, edges[1:], strict=False))])
    high = edges[-1]
    while low < high:
        middle = (low + high) // 2
        if packed(edges, middle, shards) is not None:
            high = middle
        else:
            low = middle + 1
    return low


def packed(edges: list[int], capacity: int, shards: int) -> list[int] | None:
    """Greedy cuts as indexes into ``edges``; None if more than ``shards`` runs are needed."""
    cuts, at = [], 0
    while at < len(edges) - 1:
        if len(cuts) == shards:
            return None
        at = bisect_right(edges, edges[at] + capacity) - 1
        cuts.append(at)
    return cuts


def even_cuts(edges: list[int], capacity: int, shards: int) -> list[int]:
    """``shards - 1`` cuts that keep every run within ``capacity``, each as near to an equal share as that allows.

    The smallest capacity leaves room for many cuts; greedy packing would leave the last shards short.
    """
    latest = [len(edges) - 1]
    for _ in range(shards - 1):
        latest.append(bisect_left(edges, edges[latest[-1]] - capacity))
    earliest = latest[::-1]  # earliest[j]: the rest from there fits into the shards that are left
    cuts, at = [], 0
    for j in range(shards - 1):
        low = max(at, earliest[j])
        high = max(low, bisect_right(edges, edges[at] + capacity) - 1)
        ideal = edges[at] + (edges[-1] - edges[at]) / (shards - j)
        i = min(max(bisect_left(edges, ideal), low), high)
        if i > low and ideal - edges[i - 1] < edges[i] - ideal:
            i -= 1
        cuts.append(at := i)
    return cuts


def _histogram(groups: DataFrame, digits: int, parents: list[str] | None = None) -> list[tuple[str, int, bool]]:
    """Prefix, bytes, and whether it is one group."""
    if parents is not None:
        groups = groups.where(F.substring("key", 1, len(parents[0])).isin(parents))
    rows = groups.groupBy(F.substring("key", 1, digits).alias("prefix")).agg(
        F.sum("size").alias("bytes"), (F.min("key") == F.max("key")).alias("single")).collect()
    return [(r["prefix"], r["bytes"], r["single"]) for r in rows]


def contiguous_cuts(groups: DataFrame, shards: int) -> tuple[int, list[str]]:
    """Capacity and the key prefixes at which the 2nd and later shards begin; ``groups``: rows of ``key, size``."""
    buckets = sorted(_histogram(groups, FIRST_DIGITS))
    while True:
        edges = [0]
        for _, size, _ in buckets:
            edges.append(edges[-1] + size)
        if not buckets or shards < 2:
            return edges[-1], ["g"] * (shards - 1)
        known = max([0, *(size for _, size, single in buckets if single)])
        high = smallest_capacity(edges, shards)
        low = max(known, -(-edges[-1] // shards))
        split, first, last = set(), 0, 0
        for _ in range(shards):  # where the j-th cut may fall, for capacities from low to high
            i = min(bisect_right(edges, first + low) - 1, len(buckets) - 1)
            first, last = edges[i], min(last + high, edges[-1])
            while i < len(buckets) and edges[i] < last:
                if not buckets[i][2] and edges[i + 1] > first:
                    split.add(buckets[i][0])
                i += 1
        if not split or low == high:
            cuts = even_cuts(edges, high, shards)
            return high, [buckets[i][0] if i < len(buckets) else "g" for i in cuts]
        for digits in {len(p) for p in split}:
            own = [p for p in split if len(p) == digits]
            buckets = [b for b in buckets if b[0] not in split or len(b[0]) != digits] + _histogram(groups, digits + 1, own)
        buckets.sort()


def shard_documents(docs: DataFrame, shards: int = 24, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, key, shard, slot`` for every row; ``key`` is the text's digest."""
    body = F.col(text).cast("string")
    rows = pin(docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(body), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(body), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.md5(body), F.lit("-")).alias("key")), "sharding")
    total = rows.agg(F.sum("size")).first()[0] or 0
    share = max(1, -(-total // shards))
    large = rows.groupBy("key").agg(F.sum("size").alias("bytes")).where(F.col("bytes") >= share).collect()  # <= shards rows
    large = [r["key"] for r in sorted(large, key=lambda r: (-r["bytes"], r["key"]))]
    rest, left = rows, shards - len(large)
    if large:
        rest = rows.where(~F.col("key").isin(large))
    if left:
        _, cuts = contiguous_cuts(rest.select("key", "size"), left)
        shard = F.lit(len(large))
        for cut in cuts:
            shard = shard + (F.col("key") >= cut).cast("int")
    else:
        shard = F.lit(shards - 1)
    for i, key in enumerate(large):
        shard = F.when(F.col("key") == key, F.lit(i)).otherwise(shard)
    placed = (rows.withColumn("shard", shard.cast("int")).withColumn("_key", F.substring("key", 1, FIRST_DIGITS))
              .withColumn("_part", F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 1, 2))
              .withColumn("_one", F.lit(1)))
    placed = running_total(placed, "_one", ["shard"], [["_key"], ["_part"]], ["key", "doc_id"], "slot")
    return placed.select("doc_id", "size", "text_crc32", "key", "shard", F.col("slot").cast("long").alias("slot"))

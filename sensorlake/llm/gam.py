"""Quality classifier: a generalised additive model with pairwise interactions (operator 2).

Every feature of a text has a lookup table over its bins, learned by boosting: round by
round and feature by feature, a tree of a few leaves on that feature alone is fitted to the
current gradients and added to the feature's table with a small step.  Then the pairs of
features whose joint histogram explains most of what is left get tables of their own, learned
the same way with four-leaf trees.  A text's score is the logistic of the sum of its entries.

The features are read off the whole text: shares of kinds of characters and words, repetition,
and lengths, computed for many texts at once on their bytes.  The model is fitted on at most
``SAMPLE_ROWS`` labelled rows, those with the smallest hashes of their ids; this is the only
bound.  The fitted tables are a few kilobytes and go to the executors with the scoring job.

Defined results: a null text is scored as an empty one; texts without a label are scored like
others and rows with a null id or label are not learned from; repeated rows score alike; without
both labels in the sample every score is the share of label 1 (0.5 without any row).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.llm import words as W
from sensorlake.llm.ship import ship

SAMPLE_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 64, 16, 8
ROUNDS, PAIR_ROUNDS, RATE, LEAVES = 200, 60, 0.1, 3
HELD_OUT = 2  # of crc32(doc_id) mod 4
SLICE = 1 << 20

FEATURES = (
    "log_bytes", "log_words", "bytes_per_word", "upper", "digits", "symbols", "marks", "bars", "stops", "beyond_ascii",
    "lines_per_word", "repeated_next", "distinct_words", "capital_words", "symbol_ends", "letterless_words", "repeated_pairs", "repeated_lines",
)


# ---- features ---------------------------------------------------------------------------------

def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_UPPER, _DIGIT = _class(bytes(range(65, 91))), _class(b"0123456789")
_SYMBOL, _MARK, _BAR, _STOP = _class(b"#$%&*+/<=>@\\^_`{}~[]"), _class(b"!?"), _class(b"|"), _class(b".,;:")
_BEYOND, _LINE = np.arange(256) >= 128, _class(b"\n")
_LETTER = _BEYOND | _class(bytes([*range(65, 91), *range(97, 123)]))


def _sums(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(marks)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)


def _repeats(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of each text's hashes stand in it before."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((hashes, owner))
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    return _sums(again, offsets)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text."""
    size = np.diff(offsets).astype(float)
    per_byte = lambda marks: _sums(marks[data], offsets) / np.maximum(size, 1)
    hashes, ends = W.word_hashes(data, offsets)
    n = np.diff(ends).astype(float)
    some = np.maximum(n, 1)
    inside = ~W._SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    begins[cuts] = inside[cuts]
    starts = np.flatnonzero(begins)
    stops = np.append(starts[1:], len(data)) if len(starts) else starts
    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    spaces = np.concatenate([[0], np.cumsum(~inside)])
    last = stops - (spaces[stops] - spaces[starts]) - 1  # white space follows a word up to the next one
    first = np.zeros(len(hashes), bool)
    first[ends[:-1][ends[:-1] < len(hashes)]] = True
    next_ = np.zeros(len(hashes), bool)
    next_[1:] = (hashes[1:] == hashes[:-1]) & ~first[1:]
    pairs = W.mix64(hashes * np.uint64(3) + np.concatenate([hashes[1:], hashes[:1]]))
    pair_ends = np.concatenate([[0], np.cumsum(np.maximum(np.diff(ends) - 1, 0))])
    is_pair = np.ones(len(hashes), bool)
    is_pair[ends[1:][np.diff(ends) > 0] - 1] = False
    # lines: the polynomial hash of the bytes between line feeds
    breaks = _LINE[data].copy()
    line_starts = np.unique(np.concatenate([cuts, np.flatnonzero(breaks) + 1]))
    line_starts = line_starts[line_starts < len(data)]
    if len(line_starts):
        terms = np.where(breaks, np.uint64(0), data.astype(np.uint64) + np.uint64(1)) * W.powers(len(data))
        lines = np.add.reduceat(terms, line_starts) * W.powers(len(data), W.inverse())[line_starts]
    else:
        lines = np.zeros(0, np.uint64)
    line_ends = np.searchsorted(line_starts, offsets)
    n_lines = np.maximum(np.diff(line_ends), 1)
    return np.stack([
        np.log1p(size), np.log1p(n), size / some, per_byte(_UPPER), per_byte(_DIGIT), per_byte(_SYMBOL), per_byte(_MARK), per_byte(_BAR),
        per_byte(_STOP), per_byte(_BEYOND), _sums(breaks, offsets) / some, _sums(next_, ends) / some, 1 - _repeats(hashes, ends) / some,
        _sums(_UPPER[data[starts]], ends) / some, _sums((_SYMBOL | _MARK)[data[last]], ends) / some,
        _sums(letters[stops] == letters[starts], ends) / some,
        _repeats(pairs[is_pair], pair_ends) / np.maximum(n - 1, 1), _repeats(lines, line_ends) / n_lines,
    ], 1)


# ---- the model ------------------------------------------------------------------------------------

@dataclass
class Model:
    intercept: float
    edges: list[np.ndarray]  # of each feature's bins
    tables: np.ndarray  # FEATURES x BINS
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)  # PAIR_BINS x PAIR_BINS each

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of features: bins are looked up and added."""
        bins = binned(x, self.edges)
        total = np.full(len(x), self.intercept)
        for f in range(len(self.edges)):
            total += self.tables[f][bins[:, f]]
        for (f, g), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[bins[:, f] * PAIR_BINS // BINS, bins[:, g] * PAIR_BINS // BINS]
        return 1 / (1 + np.exp(-total))


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(edges)], 1)


def bin_edges(x: np.ndarray) -> list[np.ndarray]:
    """Quantiles of each feature, spread over the BINS so that equal values share a bin."""
    out = []
    for f in range(x.shape[1]):
        e = np.unique(np.quantile(x[:, f], np.arange(1, BINS) / BINS, method="higher"))
        out.append(e[:BINS - 1])
    return out


def _split(grad: np.ndarray, hess: np.ndarray, leaves: int) -> np.ndarray:
    """A tree over ordered bins with the given sums: the value of each bin; the best cut first."""
    cuts = [0, len(grad)]
    g, h = np.concatenate([[0], np.cumsum(grad)]), np.concatenate([[0], np.cumsum(hess)])
    gain = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)
    for _ in range(leaves - 1):
        best = (1e-9, None)
        for a, b in zip(cuts, cuts[1:], strict=False):
            at = np.arange(a + 1, b)
            if len(at):
                win = gain(a, at) + gain(at, b) - gain(a, b)
                if win.max() > best[0]:
                    best = (win.max(), int(at[win.argmax()]))
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(grad))
    for a, b in zip(cuts, cuts[1:], strict=False):
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + 1.0)
    return out


def _quarter(grad: np.ndarray, hess: np.ndarray) -> tuple[float, np.ndarray]:
    """The best pair of cuts of a joint histogram, one on each axis: its gain and the value of each cell."""
    g, h = grad.cumsum(0).cumsum(1), hess.cumsum(0).cumsum(1)
    top, side = g[:-1, -1:], g[-1:, :-1]
    parts = [(g[:-1, :-1], h[:-1, :-1]), (top - g[:-1, :-1], h[:-1, -1:] - h[:-1, :-1]), (side - g[:-1, :-1], h[-1:, :-1] - h[:-1, :-1]),
             (g[-1, -1] - top - side + g[:-1, :-1], h[-1, -1] - h[:-1, -1:] - h[-1:, :-1] + h[:-1, :-1])]
    gain = sum(a ** 2 / (b + 1.0) for a, b in parts)
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    out = np.empty_like(grad)
    values = [(a / (b + 1.0))[i, j] for a, b in parts]
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = values
    return float(gain[i, j] - g[-1, -1] ** 2 / (h[-1, -1] + 1.0)), out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting on the logistic loss; rows in any order give the same model up to rounding."""
    n_features = len(FEATURES)
    if not len(y) or y.min() == y.max():
        p = np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6)
        return Model(float(np.log(p / (1 - p))), [np.zeros(0)] * n_features, np.zeros((n_features, BINS)))
    edges = bin_edges(x)
    bins = binned(x, edges)
    model = Model(float(np.log(y.mean() / (1 - y.mean()))), edges, np.zeros((n_features, BINS)))
    total = np.full(len(y), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f in range(n_features):
            g, h = slopes()
            step = RATE * _split(np.bincount(bins[:, f], g, BINS), np.bincount(bins[:, f], h, BINS), LEAVES)
            model.tables[f] += step
            total += step[bins[:, f]]
    coarse = bins * PAIR_BINS // BINS
    cells = {(f, g): coarse[:, f] * PAIR_BINS + coarse[:, g] for f in range(n_features) for g in range(f)}
    joint = lambda cell, v: np.bincount(cell, v, PAIR_BINS ** 2).reshape(PAIR_BINS, PAIR_BINS)
    g, h = slopes()
    model.pairs = sorted(cells, key=lambda p: (-_quarter(joint(cells[p], g), joint(cells[p], h))[0], p))[:PAIRS]
    model.pair_tables = [np.zeros((PAIR_BINS, PAIR_BINS)) for _ in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for pair, table in zip(model.pairs, model.pair_tables, strict=True):
            g, h = slopes()
            step = RATE * _quarter(joint(cells[pair], g), joint(cells[pair], h))[1]
            table += step
            total += step.ravel()[cells[pair]]
    return model


# ---- Spark jobs -----------------------------------------------------------------------------------

def _batch_features(batch: pa.RecordBatch, text: int) -> np.ndarray:
    return features(*W.text_bytes(batch.column(text)))


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(quality, text) -> quality, x."""
    for whole in batches:
        for batch in W.slices(whole, 1, SLICE):
            x = _batch_features(batch, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))], ["quality", "x"])


def _scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(row, text) -> row, score."""
        for whole in batches:
            for batch in W.slices(whole, 1, SLICE):
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(_batch_features(batch, 1)))], ["row", "score"])

    return run


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == HELD_OUT, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", most: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``most`` labels that are not held out, chosen by the hash of their ids, each with one text."""
    ship(docs.sparkSession)
    known = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("double").alias("quality")).dropna()
    sample = known.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(most)
    body = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    # the sample is broadcast: `most` rows of two numbers; an id with many rows gives its least text, so a label is one row
    named = body.join(F.broadcast(sample.select("doc_id").distinct()), "doc_id").groupBy("doc_id").agg(F.coalesce(F.min("text"), F.lit("")).alias("text"))
    rows = named.join(F.broadcast(sample), "doc_id").select("quality", "text").mapInArrow(_sample_features, "quality double, x array<double>")
    table = rows.toArrow()
    x = np.array(table.column("x").to_pylist(), float).reshape(table.num_rows, len(FEATURES))
    y = np.asarray(table.column("quality"), float)
    order = np.lexsort((*x.T, y))  # the same model whatever order the rows come in
    return fit(x[order], y[order])


def score(docs: DataFrame, model: Model, columns: list[str] | None = None, text: str = "text") -> DataFrame:
    """``columns`` of every row of ``docs`` (all by default) as the struct ``row``, and ``score``."""
    ship(docs.sparkSession)
    row = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if columns is None else columns)]).alias("row")
    rows = docs.select(row, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, score double"
    return rows.mapInArrow(_scores(model), schema)

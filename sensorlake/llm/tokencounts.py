"""Token counts of texts without encoding them: whole-token shortcut (operator 11).

A vocabulary string is *whole* if a pre-token that spells it encodes to that one token.
``WholeTokens.prove`` finds these once, on the driver, from the vocabulary file alone: the
string's bytes have to pass the file's normalizer unchanged and come out of its splitting
rules as one pre-token, and merging that pre-token by rank has to end at the string's own
id.  (Not every string passes: merges of a lower rank may go another way.)

In the tasks a word that is a whole string counts one token.  It is found by its hash and
compared with the string byte by byte.  Every other word is cut by the vocabulary's rules;
its pre-tokens that are whole count one each, and only the rest is merged.  A word's count is
remembered, ``MEMORY_WORDS`` words at most.  Texts are counted where they are read: there is
no shuffle, so no key or source can be hot.

Where a text may be cut into words is said in ``wordids``; vocabulary files are those of ``bpe``.

Defined results: a null text is an empty one, with 0 bytes and 0 tokens; a special token's
string in a text is one token, as in the library; repeated rows and null ids are counted like
others; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm import words as W
from sensorlake.llm.bpe import LONGEST, Vocabulary, simple
from sensorlake.llm.ship import send, ship
from sensorlake.llm.wordids import MEMORY_WORDS, cut_words, spread

LIMIT = 2048
SLICE = 1 << 20
_RECENT = 100_000


def hashes_of(words: list[bytes]) -> np.ndarray:
    """The hash that ``cut_words`` gives to each word, none of them empty."""
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    terms = (data.astype(np.uint64) + np.uint64(1)) * W.powers(len(data))
    return W.mix64(np.add.reduceat(terms, starts) * W.powers(len(data), W.inverse())[starts])


class WholeTokens:
    """The whole strings of a vocabulary, sorted by hash."""

    def __init__(self, hashes: np.ndarray, offsets: np.ndarray, data: np.ndarray):
        self.hashes, self.offsets, self.data = hashes, offsets, data

    @staticmethod
    def prove(vocabulary: Vocabulary, suffix: str = "</w>") -> list[bytes]:
        """The strings whose pre-token encodes to their own token and no other, by the file's rules."""
        letters = vocabulary.letters
        strings, own = [], []
        for token, i in vocabulary.ids.items():
            body = token.removesuffix(suffix)
            if not token.endswith(suffix) or not body or any(c not in letters for c in body):
                continue
            try:
                text = bytes(letters[c] for c in body).decode()
            except UnicodeDecodeError:  # a part of a character
                continue
            if vocabulary.pieces(text) == [body]:
                strings.append(text.encode())
                own.append(i)
        found = merged(vocabulary, strings)
        return [s for s, ids, i in zip(strings, found, own, strict=True) if len(ids) == 1 and ids[0] == i]

    @staticmethod
    def table(strings: list[bytes]) -> np.ndarray:
        """Hashes, offsets and bytes of the strings as one array, to be written to a file."""
        hashes = hashes_of(strings) if strings else np.zeros(0, np.uint64)
        order = np.argsort(hashes)
        ordered = [strings[i] for i in order]
        raw = b"".join(ordered)
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in ordered])]).astype(np.int64)
        padded = np.frombuffer(raw + bytes(-len(raw) % 8), np.int64)
        return np.concatenate([[len(strings)], hashes[order].view(np.int64), offsets, padded]).astype(np.int64)

    @staticmethod
    def open(path: str) -> WholeTokens:
        flat = np.load(path, mmap_mode="r")
        n = int(flat[0])
        return WholeTokens(flat[1:n + 1].view(np.uint64), flat[n + 1:2 * n + 2], flat[2 * n + 2:].view(np.uint8))

    def holds(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Which of the words ``data[starts:ends]`` are whole strings."""
        out = np.zeros(len(hashes), bool)
        if not len(self.hashes) or not len(hashes):
            return out
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        length = self.offsets[at + 1] - self.offsets[at]
        same = np.flatnonzero((self.hashes[at] == hashes) & (length == ends - starts))
        if len(same):  # equal hashes and lengths: the bytes decide
            equal = data[spread(starts[same], length[same])] == self.data[spread(self.offsets[at[same]], length[same])]
            begins = np.cumsum(length[same]) - length[same]
            out[same] = np.logical_and.reduceat(equal, begins)
        return out


def merged(vocabulary: Vocabulary, pieces: list[bytes]) -> list[np.ndarray]:
    """The ids of pre-tokens, each merged by rank."""
    symbols = []
    for piece in pieces:
        symbols.append(vocabulary.byte_ids[np.frombuffer(piece, np.uint8)])
        symbols[-1][-1] = vocabulary.last_ids[piece[-1]]
    out = list(symbols)
    sizes = np.array([len(s) for s in symbols], np.int64)
    for low, high in ((2, 8), (9, 16), (17, LONGEST)):
        some = np.flatnonzero((sizes >= low) & (sizes <= high))
        for k in range(0, len(some), 20_000):
            part = some[k:k + 20_000].tolist()
            for i, ids in zip(part, vocabulary.merge_together([symbols[i] for i in part]), strict=True):
                out[i] = ids
    for i in np.flatnonzero(sizes > LONGEST).tolist():
        out[i] = np.array(vocabulary.merge_long(symbols[i].tolist()), np.int64)
    return out


class Counter:
    """Counts the tokens of texts; one per worker process."""

    _open: dict[tuple[str, str], Counter] = {}

    def __init__(self, vocabulary: Vocabulary, whole: WholeTokens):
        self.vocabulary, self.whole = vocabulary, whole
        self.merged_words = 0  # words that were not whole and not remembered
        self.forget()

    @staticmethod
    def of(vocabulary: str, whole: str) -> Counter:
        key = (vocabulary, whole)
        if key not in Counter._open:
            Counter._open[key] = Counter(Vocabulary(SparkFiles.get(vocabulary)), WholeTokens.open(SparkFiles.get(whole)))
        return Counter._open[key]

    def forget(self) -> None:
        self.known = [(np.zeros(0, np.uint64), np.zeros(0, np.int64)) for _ in range(2)]  # large, recent

    def _learn(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        large, recent = self.known
        recent = self._together(recent, (hashes, counts))
        if len(recent[0]) > _RECENT:
            large, recent = self._together(large, recent), tuple(c[:0] for c in recent)
        self.known = [large, recent]

    @staticmethod
    def _together(a: tuple, b: tuple) -> tuple:
        hashes, counts = (np.concatenate(c) for c in zip(a, b, strict=True))
        order = np.argsort(hashes)
        return hashes[order], counts[order]

    def count_words(self, words: list[bytes]) -> np.ndarray:
        """Tokens of words that are not whole: their pre-tokens that are whole count one, the rest is merged."""
        self.merged_words += len(words)
        owner: list[int] = []
        pieces: list[bytes] = []
        counts = np.zeros(len(words), np.int64)
        letters = self.vocabulary.letters
        for i, word in enumerate(words):
            if (same := simple(word)) is not None:
                owner.append(i)
                pieces.append(same)
                continue
            for piece in self.vocabulary.pieces(word.decode()):
                if isinstance(piece, int):  # a special token
                    counts[i] += 1
                else:
                    owner.append(i)
                    pieces.append(bytes(letters[c] for c in piece))
        if not pieces:
            return counts
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum([len(p) for p in pieces])
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        whole = self.whole.holds(data, starts, ends, hashes_of(pieces))
        each = np.ones(len(pieces), np.int64)
        rest = np.flatnonzero(~whole)
        each[rest] = [len(ids) for ids in merged(self.vocabulary, [pieces[i] for i in rest.tolist()])]
        return counts + np.bincount(np.array(owner), each, len(words)).astype(np.int64)

    def count(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The number of tokens of each text."""
        if sum(len(k) for k, _ in self.known) > MEMORY_WORDS:
            self.forget()
        plain, starts, ends, hashes, texts = cut_words(data, offsets)
        distinct, sample, place = np.unique(hashes, return_index=True, return_inverse=True)
        whole = self.whole.holds(plain, starts[sample], ends[sample], distinct)
        tokens = np.where(whole, 1, -1)
        for known, counts in self.known:
            if len(known):
                at = np.minimum(np.searchsorted(known, distinct), len(known) - 1)
                hit = ~whole & (known[at] == distinct)
                tokens[hit] = counts[at[hit]]
        new = np.flatnonzero(tokens < 0)
        if len(new):
            raw, at = plain.tobytes(), sample[new]
            tokens[new] = self.count_words([raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
            self._learn(distinct[new], tokens[new])
        before = np.concatenate([[0], np.cumsum(tokens[place])])
        return before[texts[1:]] - before[texts[:-1]]


def _count(vocabulary: str, whole: str):
    """(doc_id, text) -> doc_id, n_bytes, n_tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter.of(vocabulary, whole)
        for all_rows in batches:
            for batch in W.slices(all_rows, 1, SLICE):
                data, offsets = W.text_bytes(batch.column(1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.diff(offsets), pa.int64()), pa.array(counter.count(data, offsets), pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every whole text; ``path``: the vocabulary file."""
    spark = docs.sparkSession
    ship(spark)
    file = os.path.join(tempfile.mkdtemp(prefix="sensorlake-whole-"), "whole.npy")
    np.save(file, WholeTokens.table(WholeTokens.prove(Vocabulary(path))))
    body = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    counted = body.mapInArrow(_count(send(spark, path), send(spark, file)), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

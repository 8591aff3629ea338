"""Ids of texts from the ids of their words, many texts at once.

Words end at SPACES, and where an ASCII letter meets a point: a token of the vocabularies
used here holds letters or points, never both, and none spans white space, so the ids of a
text are those of its words in order.  An apostrophe may start a token with letters, and
``<|>`` stand in special tokens, so these do not cut.  A-Z count as a-z, as the ids are the
same, but not where a special token might stand or a combining mark might follow.

Different words are told apart by 64-bit hashes; what a word encodes to is kept in flat
arrays, ``MEMORY_WORDS`` words at most, after which the memory starts anew.
"""

from __future__ import annotations

import numpy as np

from sensorlake.llm import words as W

SPACES = b" \t\n\r"
MEMORY_WORDS = 1_000_000
_RECENT = 100_000


def _bytes(chars) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_GAP = _bytes(SPACES)
LETTER = _bytes([*range(0x41, 0x5B), *range(0x61, 0x7B)])
POINT = _bytes(b'!"#$%&()*+,-./:;=?@[]^_`{}~')


def cut_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes as hashed; begins, ends and hashes of the words of all texts; the n + 1 offsets of the texts' words."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if not n:
        return data, none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~_GAP[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | (LETTER[data[:-1]] & POINT[data[1:]])
    texts = offsets[:-1][offsets[:-1] < n]
    begins[texts] = inside[texts]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return data, none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    ends = np.append(starts[1:], n)
    gaps = np.concatenate([[0], np.cumsum(~inside, dtype=np.int32)])
    ends = ends - (gaps[ends] - gaps[starts])  # white space follows a word up to the next one
    # a letter before U+0300 or beyond keeps its case: with a combining mark, case may decide what NFC makes of it
    plain = np.where(np.append(data[1:], np.uint8(0)) >= 0xCC, data, W.lower(data))
    marks = np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C))
    for word in np.unique(np.searchsorted(starts, marks, "right") - 1):
        plain[starts[word]:ends[word]] = data[starts[word]:ends[word]]
    terms = np.where(inside, plain.astype(np.uint64) + np.uint64(1), np.uint64(0)) * W.powers(n)
    hashes = W.mix64(np.add.reduceat(terms, starts) * W.powers(n, W.inverse())[starts])
    return plain, starts, ends, hashes, np.searchsorted(starts, offsets)


def spread(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of all ranges of ``counts`` from ``begins``, one after the other."""
    before = np.cumsum(counts) - counts
    return np.repeat(begins - before, counts) + np.arange(counts.sum())


def _merged(a: tuple, b: tuple) -> tuple:
    both = [np.concatenate(c) for c in zip(a, b, strict=True)]
    order = np.argsort(both[0], kind="stable")
    return tuple(c[order] for c in both)


class WordEncoder:
    """Encodes texts; a subclass tells what words that are not remembered encode to."""

    def __init__(self):
        self.forget()

    def word_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one after the other, and how many each has."""
        raise NotImplementedError

    def forget(self) -> None:
        # two tables sorted by hash, so that new words are merged into a small one; columns: hash, first id, number of ids
        self.tables = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)) for _ in range(2)]
        self.flat = np.zeros(1 << 16, np.int32)
        self.used = 0

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, count = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        for known, begin, length in self.tables:
            if len(known):
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = known[at] == hashes
                first[hit], count[hit] = begin[at[hit]], length[at[hit]]
        return first, count

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        """``hashes`` in ascending order, none of them known."""
        ids, count = self.word_ids(words)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used:self.used + len(ids)] = ids
        begin = self.used + np.cumsum(count, dtype=np.int64) - count
        self.used += len(ids)
        large, small = self.tables
        small = _merged(small, (hashes, begin, count.astype(np.int32)))
        if len(small[0]) > _RECENT:
            large, small = _merged(large, small), tuple(c[:0] for c in small)
        self.tables = [large, small]

    def encode(self, data: np.ndarray, offsets: np.ndarray, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, ``end`` after each if given, and the number of ids of each text."""
        if sum(len(t[0]) for t in self.tables) > MEMORY_WORDS:
            self.forget()
        plain, starts, ends, hashes, texts = cut_words(data, offsets)
        distinct, sample, place = np.unique(hashes, return_index=True, return_inverse=True)
        first, count = self._find(distinct)
        new = np.flatnonzero(first < 0)
        if len(new):
            raw, at = plain.tobytes(), sample[new]
            self._learn(distinct[new], [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
            first[new], count[new] = self._find(distinct[new])
        own = count[place]
        before = np.concatenate([[0], np.cumsum(own)])
        n_ids = before[texts[1:]] - before[texts[:-1]]
        ids = self.flat[spread(first[place], own)]
        if end is None:
            return ids, n_ids
        out = np.full(len(n_ids) + len(ids), end, np.int32)
        out[np.arange(len(ids)) + np.repeat(np.arange(len(n_ids)), n_ids)] = ids  # an end id stands behind each earlier text
        return out, n_ids + 1

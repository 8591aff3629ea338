"""Words and word shingles of many texts at once, as 64-bit hashes in numpy.

A word is a run of bytes outside ``\\x20`` and ``\\x09-\\x0D`` of the UTF-8 text with
A-Z lower-cased (other letters keep their case).  A batch of texts is hashed as one
byte array, so the cost is a few array passes per byte and no loop per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lower(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z as a-z."""
    return _LOWER[data]


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64."""
    out = np.ones(max(n, 1), np.uint64)
    size = 1
    while size < n:
        step = np.uint64(pow(base, size, 1 << 64))
        out[size:2 * size] = out[:min(size, n - size)] * step
        size *= 2
    return out[:n]


def inverse(base: int = _BASE) -> int:
    return pow(base, -1, 1 << 64)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of an Arrow string array and the n + 1 offsets; a null is an empty text."""
    texts = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts) or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: int, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of ``batch`` whose column ``text`` holds about ``most`` bytes; a longer single text stays whole."""
    sizes = np.diff(text_bytes(batch.column(text))[1])
    ends = np.flatnonzero(np.diff(np.cumsum(sizes) // most, append=-1)) + 1
    at = 0
    for end in ends:
        if end > at:
            yield batch.slice(at, end - at)
            at = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word in order, and the n + 1 offsets of the texts' words."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    data = _LOWER[data]
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < n]
    begins[cuts] = inside[cuts]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    # polynomial hash: the sum over the word, shifted to the word's start by the inverse power
    terms = np.where(inside, data.astype(np.uint64) + np.uint64(1), np.uint64(0)) * powers(n)
    hashes = np.add.reduceat(terms, starts) * powers(n, inverse())[starts]
    return mix64(hashes), np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every run of ``width`` words (a shorter text: of all its words), and the n + 1 offsets."""
    counts = np.diff(offsets)
    own = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    ends = np.concatenate([[0], np.cumsum(own)])
    if not len(words):
        return np.zeros(0, np.uint64), ends
    starts = np.repeat(offsets[:-1] - ends[:-1], own) + np.arange(ends[-1])
    length = np.repeat(np.minimum(counts, width), own)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    out = length.astype(np.uint64)
    for i in range(width):
        out = out * np.uint64(_BASE) + np.where(i < length, padded[starts + i], np.uint64(0))
    return mix64(out), ends

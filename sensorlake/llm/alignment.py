"""Alignment of two tokenizers' tokens over the same bytes (operator 13).

Tokenizer A encodes a blank and the text, tokenizer B the text, before which it puts the
blank itself, so the tokens of both are cuts of the same bytes.  The places where tokens of A
and tokens of B both end cut them into groups.  They are found by galloping: the shorter of a
document's two sorted lists of ends drives, and each of its ends is searched in the longer list
in doubling steps from where it is expected, then by halving the bracket; all ends of a batch
take a step together.  The common indices slice the groups, and the differences of their ranks
are the numbers of tokens of A and B in a group, the ranges that overlap.

Tokens whose ranges end together are *linked*: the last ones of each group.  Of two linked
tokens the bytes of one end the bytes of the other, so the id pairs that can ever be linked
follow from the two vocabularies (``linkable``).  That number, not the corpus, bounds the table
of pair counts, which reaches the driver and goes to every task.

A text is cut at blanks behind a character that is not white space.  A's splitting rule starts
a new piece there whatever stands before, and no piece of B holds a blank behind another
character, so the tokens of a text are those of its chunks (both are checked against the files).
Equal chunks, told by 64-bit hashes, are encoded once per worker while remembered.  A text with
a chunk whose tokens do not spell its bytes is encoded anew as a whole.

Tokenizer files: A a byte-level BPE of the ``tokenizers`` library without normalizer, B a
``sentencepiece`` model that puts a blank before a text.  Special tokens' strings are plain text.

Defined results: null and empty texts, and texts whose tokens do not spell the blank and the
text (with a character that B takes for a blank, say), have no tokens: empty lists.  Repeated
rows and null ids are aligned like others; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm import words as W
from sensorlake.llm.scratch import pin
from sensorlake.llm.ship import send, ship
from sensorlake.llm.wordids import spread

SLICE = 1 << 19        # bytes of text at once
TOKENS = 1 << 16       # tokens of A at once
MEMORY_CHUNKS, MEMORY_IDS = 300_000, 4_000_000
MOST_PAIRS = 32_000_000
#: Ids as little-endian integers of 2 bytes (4 where a vocabulary needs them); a bit for each token, set where it ends a group.
ALIGNED = "doc_id long, a_ids binary, b_ids binary, a_ends binary, b_ends binary"
_BLANK = "▁"
_RECENT = 50_000


# ---- vocabularies -----------------------------------------------------------------------------

class Spelling:
    """The bytes of every token, one after the other, by id."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def matches(self, ids: np.ndarray, counts: np.ndarray, raw: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Which runs of ``counts`` ids spell their strings, ``sizes`` bytes of ``raw`` each."""
        own = self.lengths[ids]
        total = np.add.reduceat(np.append(own, 0), np.minimum(np.cumsum(counts) - counts, len(own)))
        out = (total == sizes) & (counts > 0)
        if out.any():
            spelled = self.data[spread(self.begins[ids], own)]
            same = np.flatnonzero(out)
            at = np.cumsum(total) - total  # runs that came out with another length stay apart
            equal = spelled[spread(at[same], sizes[same])] == raw[spread((np.cumsum(sizes) - sizes)[same], sizes[same])]
            out[same] = np.logical_and.reduceat(equal, np.cumsum(sizes[same]) - sizes[same])
        return out


def byte_level_tokens(path: str) -> list[bytes]:
    """The bytes of a byte-level vocabulary's entries by id; special tokens spell nothing."""
    from sensorlake.llm.bpe import byte_letters

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    split = spec["pre_tokenizer"]
    if spec["normalizer"] is not None or split["type"] != "ByteLevel" or not split["use_regex"] or spec["model"]["continuing_subword_prefix"] or spec["model"]["end_of_word_suffix"]:
        raise ValueError("tokenizer A has to be a byte-level BPE without normalizer")
    letters = {c: b for b, c in enumerate(byte_letters())}
    vocab = spec["model"]["vocab"]
    out = [b""] * (max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
    for token, i in vocab.items():
        if all(c in letters for c in token):
            out[i] = bytes(letters[c] for c in token)
    return out


def piece_tokens(model) -> list[bytes]:
    """The bytes of a sentencepiece model's pieces by id."""
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_control(i) or model.is_unknown(i):
            out.append(b"")
        elif model.is_byte(i):
            out.append(bytes([int(piece[1:-1], 16)]))
        elif _BLANK in piece.lstrip(_BLANK):
            raise ValueError("tokenizer B has a piece with a blank behind another character")
        else:
            out.append(piece.replace(_BLANK, " ").encode())
    return out


def linkable(a: list[bytes], b: list[bytes]) -> int:
    """How many id pairs can be linked: the bytes of one end the bytes of the other."""
    by_a, by_b = Counter(filter(None, a)), Counter(filter(None, b))
    longer_a = sum(n * by_b[t[i:]] for t, n in by_a.items() for i in range(len(t)))
    return longer_a + sum(n * by_a[t[i:]] for t, n in by_b.items() for i in range(1, len(t)))


# ---- galloping intersection ---------------------------------------------------------------------

def gallop(table: np.ndarray, keys: np.ndarray, hint: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each key the first place of ``table[low:high]`` that is not below it, or ``high``: doubling steps
    from ``hint`` until the key is bracketed, then halving."""
    left, right = low.copy(), high.copy()
    at = np.clip(hint, low, high - 1)
    up = table[at] < keys
    left[up], right[~up] = at[up] + 1, at[~up]
    active, step = np.arange(len(keys)), 1
    while len(active):
        probe = at[active] + np.where(up[active], step, -step)
        inside = (probe >= left[active]) & (probe < right[active])
        active, probe = active[inside], probe[inside]
        below = table[probe] < keys[active]
        left[active[below]] = probe[below] + 1
        right[active[~below]] = probe[~below]
        active = active[below == up[active]]
        step *= 2
    active = np.flatnonzero(left < right)
    while len(active):
        middle = (left[active] + right[active]) // 2
        below = table[middle] < keys[active]
        left[active[below]] = middle[below] + 1
        right[active[~below]] = middle[~below]
        active = active[left[active] < right[active]]
    return left


def common_ends(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The indices of equal values in ``a`` and ``b``: the sorted lists of documents, ``n_a`` and ``n_b``
    long; the values rise over all documents.  In each document the shorter list drives."""
    in_a, in_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    some = (n_a > 0) & (n_b > 0)
    for short, n_s, first_s, in_s, long, n_l, first_l, in_l, docs in (
            (a, n_a, first_a, in_a, b, n_b, first_b, in_b, some & (n_a <= n_b)), (b, n_b, first_b, in_b, a, n_a, first_a, in_a, some & (n_a > n_b))):
        docs = np.flatnonzero(docs)
        count = n_s[docs]
        at = spread(first_s[docs], count)
        low, size = np.repeat(first_l[docs], count), np.repeat(n_l[docs], count)
        hint = low + (at - np.repeat(first_s[docs], count)) * size // np.repeat(count, count)
        found = gallop(long, short[at], hint, low, low + size)
        hit = (found < low + size) & (long[np.minimum(found, len(long) - 1)] == short[at]) if len(at) else np.zeros(0, bool)
        in_s[at[hit]], in_l[found[hit]] = True, True
    return np.flatnonzero(in_a), np.flatnonzero(in_b)


# ---- chunks -------------------------------------------------------------------------------------

def cut_chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' bytes, each non-empty text behind a blank; begins and hashes of all chunks, and the n + 1
    offsets of the texts' chunks."""
    some = np.diff(offsets) > 0
    data = np.insert(data, offsets[:-1][some], np.uint8(0x20))
    offsets = offsets + np.concatenate([[0], np.cumsum(some)])
    n = len(data)
    if not n:
        return data, np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    b1, b2, b3 = (np.concatenate([np.zeros(min(k, n), np.uint8), data[:-k]]) for k in (1, 2, 3))
    # white space beyond ASCII ends in these bytes; other characters that do so only make a chunk longer
    wide = (b2 == 0xC2) & ((b1 == 0x85) | (b1 == 0xA0))
    wide |= ((b3 == 0xE1) & (b2 == 0x9A)) | ((b3 == 0xE2) & ((b2 == 0x80) | (b2 == 0x81))) | ((b3 == 0xE3) & (b2 == 0x80))
    begins = (data == 0x20) & (b1 > 0x20) & (b1 != 0x7F) & ~wide
    begins[offsets[:-1][some]] = True
    starts = np.flatnonzero(begins)
    terms = (data.astype(np.uint64) + np.uint64(1)) * W.powers(n)
    hashes = W.mix64(np.add.reduceat(terms, starts) * W.powers(n, W.inverse())[starts])
    return data, starts, hashes, np.searchsorted(starts, offsets)


class Aligner:
    """Encodes texts with both tokenizers and aligns the tokens; one per worker process."""

    _open: dict[tuple[str, str], Aligner] = {}

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        self.b = SentencePieceProcessor(model_file=path_b)
        self.spell_a, self.spell_b = Spelling(byte_level_tokens(path_a)), Spelling(piece_tokens(self.b))
        self.lead = len(self.b.encode("a"))
        self.forget()

    @staticmethod
    def of(a: str, b: str) -> Aligner:
        if (a, b) not in Aligner._open:
            Aligner._open[a, b] = Aligner(SparkFiles.get(a), SparkFiles.get(b))
        return Aligner._open[a, b]

    def forget(self) -> None:
        # sorted by hash; columns: hash, first id and number of ids of A, of B, and whether they spell the chunk
        empty = (np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(4)), np.zeros(0, bool))
        self.tables = [empty, empty]
        self.flat = [np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)]
        self.used = [0, 0]

    def _encode(self, chunks: list[bytes]) -> tuple[np.ndarray, ...]:
        """First id and number of ids of A and of B for each chunk, and whether both spell it."""
        texts = [c.decode() for c in chunks]
        found_a = [e.ids for i in range(0, len(texts), 5_000) for e in self.a.encode_batch_fast(texts[i:i + 5_000], add_special_tokens=False)]
        found_b = self.b.encode([t[1:] for t in texts], num_threads=1) if texts else []
        for i, text in enumerate(texts):
            if text == " ":  # before an empty text B puts no blank
                found_b[i] = self.b.encode("a ")[self.lead:]
        raw, sizes = np.frombuffer(b"".join(chunks), np.uint8), np.array([len(c) for c in chunks], np.int64)
        out, good = [], np.ones(len(chunks), bool)
        for k, (found, spelling) in enumerate(((found_a, self.spell_a), (found_b, self.spell_b))):
            count = np.array([len(x) for x in found], np.int64)
            ids = np.fromiter((i for x in found for i in x), np.int32, int(count.sum()))
            good &= spelling.matches(ids, count, raw, sizes)
            while self.used[k] + len(ids) > len(self.flat[k]):
                self.flat[k] = np.concatenate([self.flat[k], np.zeros_like(self.flat[k])])
            self.flat[k][self.used[k]:self.used[k] + len(ids)] = ids
            out += [self.used[k] + np.cumsum(count) - count, count]
            self.used[k] += len(ids)
        return (*out, good)

    def _records(self, hashes: np.ndarray, chunk) -> list[np.ndarray]:
        """The columns behind the hash for ascending hashes; ``chunk(i)`` gives the bytes of the i-th."""
        out = [np.full(len(hashes), -1, np.int64), *(np.zeros(len(hashes), np.int64) for _ in range(3)), np.zeros(len(hashes), bool)]
        for table in self.tables:
            if len(table[0]):
                at = np.minimum(np.searchsorted(table[0], hashes), len(table[0]) - 1)
                hit = table[0][at] == hashes
                for column, known in zip(out, table[1:], strict=True):
                    column[hit] = known[at[hit]]
        new = np.flatnonzero(out[0] < 0)
        if len(new):
            found = self._encode([chunk(i) for i in new.tolist()])
            for column, learned in zip(out, found, strict=True):
                column[new] = learned
            large, recent = self.tables
            recent = _merged(recent, (hashes[new], *found))
            if len(recent[0]) > _RECENT:
                large, recent = _merged(large, recent), tuple(c[:0] for c in recent)
            self.tables = [large, recent]
        return out

    def align(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """Ids of A and B, ranks of the tokens of A and B that end a group; numbers of A and B tokens of each text."""
        if sum(len(t[0]) for t in self.tables) > MEMORY_CHUNKS or max(self.used) > MEMORY_IDS:
            self.forget()
        data, starts, hashes, texts = cut_chunks(data, offsets)
        ends = np.append(starts[1:], len(data))
        distinct, sample, place = np.unique(hashes, return_index=True, return_inverse=True)
        raw = data.tobytes()
        records = self._records(distinct, lambda i: raw[starts[sample[i]]:ends[sample[i]]])
        owner = np.repeat(np.arange(len(texts) - 1), np.diff(texts))
        odd = np.unique(owner[~records[4][place]])
        keep = np.ones(len(place), bool)
        for doc in odd.tolist():  # one chunk, as a whole; without tokens if they do not spell it
            first, last = texts[doc], texts[doc + 1]
            whole = self._encode([raw[starts[first]:ends[last - 1]]])
            good = whole[4][0]
            whole = [w if k in (0, 2) or good else w * 0 for k, w in enumerate(whole)]
            records = [np.concatenate([r, w]) for r, w in zip(records, whole, strict=True)]
            place[first] = len(records[0]) - 1
            keep[first + 1:last] = False
        place, owner = place[keep], owner[keep]
        first_a, count_a, first_b, count_b, _ = (r[place] for r in records)
        n = len(texts) - 1
        n_a = np.bincount(owner, count_a, n).astype(np.int64)
        n_b = np.bincount(owner, count_b, n).astype(np.int64)
        a, b = self.flat[0][spread(first_a, count_a)], self.flat[1][spread(first_b, count_b)]
        # both tokenizers spell the same bytes, so the running ends of a batch compare across all of its texts
        at_a, at_b = common_ends(np.cumsum(self.spell_a.lengths[a]), np.cumsum(self.spell_b.lengths[b]), n_a, n_b)
        return a, b, at_a, at_b, n_a, n_b


def _merged(a: tuple, b: tuple) -> tuple:
    both = [np.concatenate(c) for c in zip(a, b, strict=True)]
    order = np.argsort(both[0], kind="stable")
    return tuple(c[order] for c in both)


# ---- Spark --------------------------------------------------------------------------------------

def _binary(values: np.ndarray, counts: np.ndarray, kind: str) -> pa.Array:
    """One binary value for each run of ``counts`` values."""
    raw = values.astype(kind)
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32) * raw.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw.tobytes())])


def _bits(places: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary value for each run of ``counts`` bits, of which those at ``places`` are set."""
    width = (counts + 7) // 8
    out = np.zeros(8 * int(width.sum()), np.uint8)
    out[spread(8 * (np.cumsum(width) - width), counts)[places]] = 1
    return _binary(np.packbits(out), width, "u1")


def _places(column: pa.Array, counts: np.ndarray) -> np.ndarray:
    """The places that ``_bits`` has set."""
    data, offsets = W.text_bytes(column)
    return np.flatnonzero(np.unpackbits(data)[spread(8 * offsets[:-1], counts)])


def _align(a: str, b: str, kind: str):
    """(doc_id, text) -> ALIGNED."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner.of(a, b)
        for whole in batches:
            for batch in W.slices(whole, 1, SLICE):
                ids_a, ids_b, at_a, at_b, n_a, n_b = aligner.align(*W.text_bytes(batch.column(1)))
                yield pa.RecordBatch.from_arrays([batch.column(0), _binary(ids_a, n_a, kind), _binary(ids_b, n_b, kind), _bits(at_a, n_a), _bits(at_b, n_b)],
                                                 ["doc_id", "a_ids", "b_ids", "a_ends", "b_ends"])

    return run


class Tokenizers:
    """The two tokenizer files, and what follows from their vocabularies."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor

        self.path_a, self.path_b = path_a, path_b
        self.tokens_a, self.tokens_b = byte_level_tokens(path_a), piece_tokens(SentencePieceProcessor(model_file=path_b))
        self.n_ids = max(len(self.tokens_a), len(self.tokens_b))
        self.kind = "<u2" if self.n_ids <= 1 << 16 else "<u4"


def align(docs: DataFrame, both: Tokenizers, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``ALIGNED``: the ids of A and B, and which tokens end a group, of every whole text."""
    spark = docs.sparkSession
    ship(spark)
    body = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return body.mapInArrow(_align(send(spark, both.path_a), send(spark, both.path_b), both.kind), ALIGNED)


def _parts(batch: pa.RecordBatch, kind: str) -> Iterator[tuple[pa.Array, tuple[np.ndarray, ...], tuple[np.ndarray, ...]]]:
    """Of ALIGNED rows, some at a time: document ids; ids of A and B and group sizes in A and B, one document
    after the other; numbers of A and B tokens and of groups of each document."""
    Aligner._open.clear()  # a worker that has encoded before needs the room
    for part in W.slices(batch, 1, TOKENS * np.dtype(kind).itemsize):
        ids, counts, ends = [], [], []
        for k in (1, 2):
            data, offsets = W.text_bytes(part.column(k))
            ids.append(np.frombuffer(data, kind).astype(np.int64))
            counts.append(np.diff(offsets) // np.dtype(kind).itemsize)
            ends.append(_places(part.column(k + 2), counts[-1]))
        n_groups = np.diff(np.searchsorted(ends[0], np.concatenate([[0], np.cumsum(counts[0])])))
        yield part.column(0), (*ids, *(np.diff(e, prepend=-1) for e in ends)), (*counts, n_groups)


def unpacked(aligned: DataFrame, both: Tokenizers) -> DataFrame:
    """``doc_id``, the ids of A and B, and per group the numbers of A and of B tokens, as arrays."""
    kind, names = both.kind, ["doc_id", "a_ids", "b_ids", "a_sizes", "b_sizes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, flat, counts in _parts(batch, kind):
                lists = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(x, pa.int32()))
                         for x, n in zip(flat, (*counts, counts[2]), strict=True)]
                yield pa.RecordBatch.from_arrays([doc_id, *lists], names)

    return aligned.mapInArrow(run, "doc_id long, " + ", ".join(f"{n} array<int>" for n in names[1:]))


def _links(flat: tuple[np.ndarray, ...]) -> np.ndarray:
    """The linked id pairs, A's id in the upper half: the last tokens of every group."""
    a, b, sizes_a, sizes_b = flat
    return a[np.cumsum(sizes_a) - 1] << 32 | b[np.cumsum(sizes_b) - 1]


def _count_links(kind: str):
    """ALIGNED -> pair, n: partial counts."""
    rows = lambda p, n: pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(n, pa.int64())], ["pair", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for _, flat, _ in _parts(batch, kind):
                own, n = np.unique(_links(flat), return_counts=True)
                pairs, place = np.unique(np.concatenate([pairs, own]), return_inverse=True)
                counts = np.bincount(place, np.concatenate([counts, n]), len(pairs)).astype(np.int64)
            if len(pairs) > 1_000_000:
                yield rows(pairs, counts)
                pairs, counts = pairs[:0], counts[:0]
        yield rows(pairs, counts)

    return run


def link_counts(aligned: DataFrame, both: Tokenizers) -> DataFrame:
    """``a, b, n``: how often the ids are linked in all documents."""
    pairs = aligned.mapInArrow(_count_links(both.kind), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return pairs.select(F.shiftright("pair", 32).cast("int").alias("a"), F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("b"), "n")


def group_texts(flat: tuple[np.ndarray, ...], counts: tuple[np.ndarray, ...], digits: tuple[np.ndarray, np.ndarray]) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3`` of all documents in one string, and the n + 1 offsets; ``digits``: of every id, and how many."""
    a, b, sizes_a, sizes_b = flat
    groups = np.arange(len(sizes_a))
    place_a = np.arange(len(a)) + np.repeat(np.cumsum(sizes_b) - sizes_b, sizes_a)  # A's tokens of a group stand before B's
    place_b = np.arange(len(b)) + np.repeat(np.cumsum(sizes_a), sizes_b)
    ids, mark = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
    ids[place_a], ids[place_b] = a, b
    last = np.cumsum(sizes_a + sizes_b)[groups] - 1
    mark[last - sizes_b] = ord("|")
    mark[last] = ord(";")
    letters, length = digits
    own = length[ids] + 1
    ends = np.cumsum(own)
    out = letters.reshape(-1)[spread(ids * letters.shape[1], own)]
    out[ends - 1] = mark
    tokens = np.concatenate([[0], np.cumsum(counts[0] + counts[1])])
    return out.tobytes(), np.concatenate([[0], ends])[tokens]


def digit_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    width = len(str(max(n - 1, 0))) + 1
    texts = [str(i).encode() for i in range(n)]
    return np.frombuffer(b"".join(t.ljust(width, b" ") for t in texts), np.uint8).reshape(n, width), np.array([len(t) for t in texts], np.int64)


def _digests(shared, n_ids: int, kind: str):
    """ALIGNED -> counts of tokens, groups and links, and the digest of the groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = shared.value
        digits = digit_table(n_ids)
        for batch in batches:
            for doc_id, flat, counts in _parts(batch, kind):
                n_a, n_b, n_groups = counts
                at = np.searchsorted(pairs, _links(flat))
                cuts = np.concatenate([[0], np.cumsum(n_groups)])
                per = [np.diff(np.concatenate([[0], np.cumsum(x[at])])[cuts]) for x in (best, n)]
                raw, ends = group_texts(flat, counts, digits)
                shas = [hashlib.sha256(raw[x:y - 1]).hexdigest() if y > x else "" for x, y in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [doc_id, *(pa.array(c, pa.int64()) for c in (n_a, n_b, n_groups, n_groups, *per)), pa.array(shas, pa.string())],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return run


def alignment_digests(docs: DataFrame, both: Tokenizers) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every document.

    The pair counts that meet in the driver have at most one row for each linkable id pair."""
    if linkable(both.tokens_a, both.tokens_b) > MOST_PAIRS:
        raise ValueError("the vocabularies allow too many id pairs for one table")
    aligned = pin(align(docs, both), "aligned")
    counts = link_counts(aligned, both).toArrow()
    a, b, n = (counts.column(c).to_numpy().astype(np.int64) for c in ("a", "b", "n"))
    order = np.argsort(a << 32 | b)
    highest = np.zeros(len(both.tokens_b), np.int64)
    np.maximum.at(highest, b, n)
    shared = docs.sparkSession.sparkContext.broadcast(((a << 32 | b)[order], n[order], (n == highest[b]).astype(np.int64)[order]))
    return aligned.mapInArrow(_digests(shared, both.n_ids, both.kind),
                              "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")

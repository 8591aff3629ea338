"""BPE encoding and decoding with a transducer lexicon (operator 8).

The corpus' frequent words are counted by Spark, encoded once, and compiled into a
minimal acyclic automaton: words share prefixes and suffixes, and the numbers on a
word's path add up to its place in a table of id sequences.  The automaton is one array
file that executors receive once and memory-map; a batch's distinct words walk it
together, a byte at a time.  Words that it does not know are normalized and cut by the
vocabulary's own rules and merged here exactly, by rank, all words of a batch in step.

What a word is, and how a text's ids follow from its words', is said in ``wordids``.

Vocabulary files: ``tokenizers`` BPE with NFC, white space to blanks, lower case, a
splitting expression, byte-level letters, an end-of-word suffix and no decoder.

Defined results: a null text is an empty one and has no ids; repeated rows and null ids
are encoded like others; special tokens in a text get their ids, as the library does.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm import words as W
from sensorlake.llm.scratch import pin
from sensorlake.llm.ship import send, ship
from sensorlake.llm.wordids import POINT, WordEncoder, cut_words, spread

LEXICON_WORDS, LONGEST = 32_768, 48
SLICE = 1 << 20


# ---- the vocabulary -------------------------------------------------------------------------

def byte_letters() -> list[str]:
    """The letter of each byte: itself where it prints in Latin-1, else the next one from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, more = [], 0x100
    for b in range(256):
        out.append(chr(b if b in own else more))
        more += b not in own
    return out


def simple(word: bytes) -> bytes | None:
    """The word in lower case if it is a single pre-token by its bytes alone: ASCII and Latin-1 letters, or points."""
    if word.isascii():
        return word.lower() if word.isalpha() or POINT[np.frombuffer(word, np.uint8)].all() else None
    text = word.decode()
    if text.isalpha() and max(text) <= "\xff" and not {"\xaa", "\xb5", "\xba"} & set(text):
        return text.lower().encode()
    return None


class Vocabulary:
    """Encodes and decodes by the rules of a vocabulary file, a word at a time."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.letters = {c: b for b, c in enumerate(letters)}
        self.byte_ids = np.array([self.ids[c] for c in letters], np.int64)
        self.last_ids = np.array([self.ids[c + suffix] for c in letters], np.int64)
        self.rank = {(self.ids[a], self.ids[b]): rank for rank, (a, b) in enumerate(model["merges"])}
        self.merge_to = np.array([self.ids[a + b] for a, b in model["merges"]], np.int64)
        self.no_rank = len(self.merge_to)
        keys = np.array([a << 32 | b for a, b in self.rank], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.array(list(self.rank.values()), np.int64)[order]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*self.ids.values(), *special.values()]) + 1
        self.tokens = np.full(size, "", object)
        for token, i in (*self.ids.items(), *special.items()):
            self.tokens[i] = token
        self.special = special
        self.special_text = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        from tokenizers import Tokenizer

        rules = Tokenizer.from_file(path)
        self.normalize, self.cut = rules.normalizer.normalize_str, rules.pre_tokenizer.pre_tokenize_str

    def pieces(self, word: str) -> list[str | int]:
        """The pre-tokens of a word, in byte letters, and the ids of special tokens in it."""
        out: list[str | int] = []
        parts = self.special_text.split(word) if self.special_text and any(s in word for s in self.special) else [word]
        for part in parts:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out += [letters for letters, _ in self.cut(self.normalize(part))]
        return out

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one after the other, and how many each has."""
        symbols: list[np.ndarray] = []  # of each piece; a special token is a piece of one symbol
        done: list[bool] = []
        owner: list[int] = []
        for i, word in enumerate(words):
            if (same := simple(word)) is not None:
                symbols.append(self.byte_ids[np.frombuffer(same, np.uint8)])
                symbols[-1][-1] = self.last_ids[same[-1]]
                done.append(False)
                owner.append(i)
                continue
            for piece in self.pieces(word.decode()):
                done.append(isinstance(piece, int))
                symbols.append(np.array([piece] if done[-1] else [self.byte_ids[self.letters[c]] for c in piece[:-1]] + [self.last_ids[self.letters[piece[-1]]]], np.int64))
                owner.append(i)
        merged: list[np.ndarray] = list(symbols)
        sizes = np.array([len(x) for x in symbols], np.int64)
        short = np.flatnonzero(~np.array(done, bool) & (sizes > 1) & (sizes <= LONGEST))
        for low, high in ((2, 8), (9, 16), (17, LONGEST)):
            own = short[(sizes[short] >= low) & (sizes[short] <= high)]
            for k in range(0, len(own), 20_000):
                part = own[k:k + 20_000]
                for i, ids in zip(part.tolist(), self.merge_together([symbols[i] for i in part.tolist()]), strict=True):
                    merged[i] = ids
        for i in np.flatnonzero(~np.array(done, bool) & (sizes > LONGEST)).tolist():
            merged[i] = np.array(self.merge_long(symbols[i].tolist()), np.int64)
        count = np.bincount(np.array(owner, np.int64), [len(x) for x in merged], len(words)).astype(np.int64) if owner else np.zeros(len(words), np.int64)
        return (np.concatenate(merged) if merged else np.zeros(0, np.int64)).astype(np.int32), count

    def merge_together(self, pieces: list[np.ndarray]) -> list[np.ndarray]:
        """Merges many short pieces in step: in each, the pair of the lowest rank, the leftmost of equal ones."""
        n, length = len(pieces), np.array([len(p) for p in pieces], np.int64)
        width = int(length.max())
        ids = np.full((n, width + 1), -1, np.int64)
        ids[np.repeat(np.arange(n), length), spread(np.zeros(n, np.int64), length)] = np.concatenate(pieces)
        ranks = self._ranks(ids[:, :-1], ids[:, 1:])
        rows = np.arange(n)
        while len(rows):
            best = ranks[rows].argmin(1)
            found = ranks[rows, best] < self.no_rank
            rows, best = rows[found], best[found]
            if not len(rows):
                break
            ids[rows, best] = self.merge_to[ranks[rows, best]]
            # what stands behind the pair moves one to the left
            column = np.arange(width)
            source = column + (column > best[:, None])
            ids[rows, :-1] = np.take_along_axis(ids[rows], source, 1)
            shifted = np.minimum(source, width - 1)
            ranks[rows] = np.take_along_axis(ranks[rows], shifted, 1)
            ranks[rows, width - 1] = self.no_rank
            ranks[rows, best] = self._ranks(ids[rows, best], ids[rows, best + 1])
            left = best > 0
            ranks[rows[left], best[left] - 1] = self._ranks(ids[rows[left], best[left] - 1], ids[rows[left], best[left]])
        return [row[row >= 0] for row in ids]

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = np.where((a >= 0) & (b >= 0), a << 32 | b, -1)
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], self.no_rank)

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same for one long piece, over a linked list of symbols and a heap of pairs."""
        n = len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(rank, i) for i in range(n - 1) if (rank := self.rank.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        gone = [False] * n
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j < 0 or self.rank.get((ids[i], ids[j])) != rank:
                continue
            ids[i], gone[j], after[i] = int(self.merge_to[rank]), True, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else -1
                if right >= 0 and (new := self.rank.get((ids[left], ids[right]))) is not None:
                    heapq.heappush(heap, (new, left))
        return [x for x, dead in zip(ids, gone, strict=True) if not dead]

    def decode(self, ids: np.ndarray) -> str:
        """The tokens' texts; without a decoder in the file the library joins them with blanks."""
        return " ".join(self.tokens[ids])


# ---- the lexicon ------------------------------------------------------------------------------

class Lexicon:
    """A minimal acyclic transducer from words to id sequences, in one array of integers."""

    def __init__(self, flat: np.ndarray):
        n_edges, n_states, n_words, n_ids = (int(x) for x in flat[:4])
        parts = np.split(flat[4:], np.cumsum([n_edges, n_edges, n_edges, n_states, n_words + 1]))
        self.edges, self.targets, self.skips, self.final, self.offsets, self.ids = parts
        self.n_states, self.n_words = n_states, n_words
        assert len(self.ids) == n_ids

    @staticmethod
    def open(path: str) -> Lexicon:
        return Lexicon(np.load(path, mmap_mode="r"))

    @staticmethod
    def build(entries: dict[bytes, list[int]]) -> np.ndarray:
        """Adds the words in order; a state that later words cannot change is replaced by an equal one, if any."""
        words = sorted(entries)
        edges: list[dict[int, int]] = [{}]  # state -> byte -> state
        final, register = [False], {}
        path = [0]  # the states of the last word

        def settle(depth: int, word: bytes) -> None:
            while len(path) - 1 > depth:
                state = path.pop()
                same = register.setdefault((final[state], tuple(edges[state].items())), state)
                if same != state:
                    edges[path[-1]][word[len(path) - 1]] = same

        last = b""
        for word in words:
            common = len(os.path.commonprefix([last, word]))
            settle(common, last)
            for b in word[common:]:
                edges.append({})
                final.append(False)
                edges[path[-1]][b] = len(edges) - 1
                path.append(len(edges) - 1)
            final[path[-1]] = True
            last = word
        settle(0, last)

        number, order, stack = {0: 0}, [0], [0]
        while stack:
            for target in edges[stack.pop()].values():
                if target not in number:
                    number[target] = len(order)
                    order.append(target)
                    stack.append(target)
        count: dict[int, int] = {}
        todo = [0]
        while todo:  # words below each state, children first
            state = todo[-1]
            missing = [t for t in edges[state].values() if t not in count]
            if missing:
                todo += missing
                continue
            todo.pop()
            count[state] = final[state] + sum(count[t] for t in edges[state].values())
        rows = []
        for state in order:
            passed = int(final[state])  # words that precede those of the edge
            for b, target in sorted(edges[state].items()):
                rows.append((number[state] * 256 + b, number[target], passed))
                passed += count[target]
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 3)
        ids = [entries[w] for w in words]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
        flat = np.array([i for x in ids for i in x], np.int64)
        ends = np.array([final[s] for s in order], np.int64)
        return np.concatenate([[len(rows), len(order), len(words), len(flat)], *table.T, ends, offsets, flat]).astype(np.int64)

    def find(self, words: list[bytes]) -> np.ndarray:
        """The place of each word, or -1."""
        lengths = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        state, place = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        alive = np.flatnonzero((lengths > 0) & (lengths <= LONGEST))
        out = np.full(len(words), -1, np.int64)
        step = 0
        while len(alive) and len(self.edges):
            key = state[alive] * 256 + data[starts[alive] + step]
            at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            known = self.edges[at] == key
            alive, at = alive[known], at[known]
            state[alive] = self.targets[at]
            place[alive] += self.skips[at]
            step += 1
            done = lengths[alive] == step
            ended = alive[done]
            ended = ended[self.final[state[ended]] == 1]
            out[ended] = place[ended]
            alive = alive[~done]
        return out


# ---- in the executors ---------------------------------------------------------------------------

class Encoder(WordEncoder):
    """Vocabulary and lexicon; one per worker process."""

    _open: dict[tuple[str, str], Encoder] = {}

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        super().__init__()
        self.vocabulary, self.lexicon = vocabulary, lexicon

    @staticmethod
    def of(vocabulary: str, lexicon: str) -> Encoder:
        key = (vocabulary, lexicon)
        if key not in Encoder._open:
            Encoder._open.clear()  # a worker lives on from one lexicon to the next
            Encoder._open[key] = Encoder(Vocabulary(SparkFiles.get(vocabulary)), Lexicon.open(SparkFiles.get(lexicon)))
        return Encoder._open[key]

    def word_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """From the lexicon where it knows the word, else merged."""
        at = self.lexicon.find(words)
        known = at >= 0
        count = np.zeros(len(words), np.int64)
        offsets = self.lexicon.offsets
        count[known] = offsets[at[known] + 1] - offsets[at[known]]
        new = np.flatnonzero(~known)
        ids, count[new] = self.vocabulary.encode_words([words[i] for i in new.tolist()])
        begin = np.cumsum(count) - count
        out = np.zeros(count.sum(), np.int32)
        out[spread(begin[known], count[known])] = self.lexicon.ids[spread(offsets[at[known]], count[known])]
        out[spread(begin[new], count[new])] = ids
        return out, count


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) -> word, n: partial counts of the words that fit the lexicon."""

    def rows(hashes: np.ndarray, words: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(words.tolist(), pa.binary()), pa.array(counts, pa.int64())], ["word", "n"])

    empty = np.zeros(0, np.uint64), np.zeros(0, object), np.zeros(0, np.int64)
    known = empty
    for whole in batches:
        for batch in W.slices(whole, 0, SLICE):
            plain, starts, ends, hashes, _ = cut_words(*W.text_bytes(batch.column(0)))
            keep = ends - starts <= LONGEST
            starts, ends, hashes = starts[keep], ends[keep], hashes[keep]
            own, sample, counts = np.unique(hashes, return_index=True, return_counts=True)
            raw = plain.tobytes()
            words = np.empty(len(own), object)
            words[:] = [raw[a:b] for a, b in zip(starts[sample].tolist(), ends[sample].tolist(), strict=True)]
            every = np.concatenate([known[0], own])
            merged, first, place = np.unique(every, return_index=True, return_inverse=True)
            known = merged, np.concatenate([known[1], words])[first], np.bincount(place, np.concatenate([known[2], counts]), len(merged)).astype(np.int64)
            if len(merged) > 200_000:
                yield rows(*known)
                known = empty
    yield rows(*known)


def _encode(vocabulary: str, lexicon: str, decoded: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(vocabulary, lexicon)
        for whole in batches:
            for batch in W.slices(whole, 1, SLICE):
                ids, counts = encoder.encode(*W.text_bytes(batch.column(1)))
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                columns = [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))]
                if decoded:
                    columns.append(pa.array([encoder.vocabulary.decode(ids[a:b]) for a, b in zip(offsets, offsets[1:], strict=False)], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][:len(columns)])

    return run


def _decode(vocabulary: str, lexicon: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = Encoder.of(vocabulary, lexicon).vocabulary.decode
        for batch in batches:
            texts = [decode(np.asarray(x.values)) if x.is_valid else "" for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])

    return run


# ---- interface --------------------------------------------------------------------------------------

class Codec:
    """A vocabulary with a lexicon compiled from a corpus, ready to use in Spark jobs."""

    def __init__(self, spark: SparkSession, vocabulary: str, lexicon: str):
        self.spark, self.vocabulary, self.lexicon = spark, vocabulary, lexicon

    @staticmethod
    def compile(texts: DataFrame, path: str, text: str = "text", most: int = LEXICON_WORDS) -> Codec:
        """Count all words of ``texts`` and compile the ``most`` frequent ones; the rest is merged when met."""
        spark = texts.sparkSession
        ship(spark)
        counts = pin(texts.select(F.col(text).cast("string")).mapInArrow(_count_words, "word binary, n long")
                     .groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
        # the words of the most frequent classes, as many classes as hold `most` words at the most
        size = F.floor(8 * F.log2("n"))
        classes = counts.groupBy(size.alias("size")).count().orderBy(F.desc("size")).collect()  # 8 for each doubling
        total, least = 0, None
        for row in classes:
            total += row["count"]
            if total > most:
                break
            least = row["size"]
        frequent = [] if least is None else [bytes(r["word"]) for r in counts.where(size >= least).collect()]
        ids, count = Vocabulary(path).encode_words(frequent)
        ends = np.cumsum(count)
        flat = Lexicon.build({w: ids[e - n:e].tolist() for w, e, n in zip(frequent, ends, count, strict=True)})
        file = os.path.join(tempfile.mkdtemp(prefix="sensorlake-bpe-"), "lexicon.npy")
        np.save(file, flat)
        return Codec(spark, send(spark, path), send(spark, file))

    def encode(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
        """``doc_id, ids`` of every whole text, and ``decoded``, the text that its ids decode to, if asked for."""
        body = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
        return body.mapInArrow(_encode(self.vocabulary, self.lexicon, decoded), "doc_id long, ids array<int>" + ", decoded string" * decoded)

    def decode(self, encoded: DataFrame) -> DataFrame:
        """``doc_id, ids, decoded`` of rows ``doc_id, ids``."""
        return encoded.select("doc_id", "ids").mapInArrow(_decode(self.vocabulary, self.lexicon), "doc_id long, ids array<int>, decoded string")

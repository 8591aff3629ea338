"""Whole-token shortcut: what is proven, and counts against the library's."""
import numpy as np
import pyarrow as pa
import pytest

from sensorlake.llm import tokencounts as C
from sensorlake.llm import words as W
from sensorlake.llm.bpe import Vocabulary

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")
TEXTS = ["don't <|endoftext|>can't A\u0301 É E\u0301 Straße ﬁ ½ 10²  12,5% ...;x", "İstanbul ẞ ǅ", "'s 're 'sx x's", None, "", " \t\n",
         "the THE The tHe", "a" * 5_000, "日本語 é W̊ \x00 \x85 x\u2003y", "supercalifragilistic " * 50, "<|startoftext|><|startoftext|>"]


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(PATH)


@pytest.fixture(scope="module")
def proven(vocabulary):
    return C.WholeTokens.prove(vocabulary)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def test_every_proven_string_is_one_token_in_the_library(proven, library):
    assert len(proven) > 30_000 and len(set(proven)) == len(proven)
    assert all(len(e.ids) == 1 for e in library.encode_batch([s.decode() for s in proven], add_special_tokens=False))


def test_strings_that_are_not_proven_are_not_one_token(vocabulary, proven, library):
    rest = []
    for token in vocabulary.ids:
        body = token.removesuffix("</w>")
        if token.endswith("</w>") and body and body.isascii() and body.isprintable():
            rest.append(body)
    known = set(proven)
    rest = [r for r in rest if r.encode() not in known]
    assert all(len(e.ids) != 1 or r != r.lower() for r, e in zip(rest, library.encode_batch(rest, add_special_tokens=False), strict=True))


def test_counts_and_memory(vocabulary, proven, library, tmp_path, monkeypatch):
    np.save(tmp_path / "whole.npy", C.WholeTokens.table(proven))
    counter = C.Counter(vocabulary, C.WholeTokens.open(str(tmp_path / "whole.npy")))
    want = [len(library.encode(t or "", add_special_tokens=False).ids) for t in TEXTS]
    column = W.text_bytes(pa.array(TEXTS, pa.string()))
    assert counter.count(*column).tolist() == want
    merged = counter.merged_words
    assert counter.count(*column).tolist() == want and counter.merged_words == merged  # remembered
    assert counter.count(*W.text_bytes(pa.array(["the cat and the dog"]))).tolist() == [5] and counter.merged_words == merged  # whole
    monkeypatch.setattr(C, "MEMORY_WORDS", 0)
    assert counter.count(*column).tolist() == want and counter.merged_words > merged


def test_equal_hashes_are_told_apart_by_their_bytes(proven):
    whole = C.WholeTokens.table(proven[:100])
    table = C.WholeTokens(whole[1:101].view(np.uint64), whole[101:202], whole[202:].view(np.uint8))
    word = sorted(proven[:100], key=len)[-1]
    forged = bytes(len(word))
    for data, expected in ((word, True), (forged, False)):
        found = table.holds(np.frombuffer(data, np.uint8), np.array([0]), np.array([len(word)]), C.hashes_of([word]))
        assert found.tolist() == [expected]
    assert table.holds(np.zeros(0, np.uint8), np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.uint64)).tolist() == []

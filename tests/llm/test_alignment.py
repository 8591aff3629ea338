"""Galloping intersection, chunks, and the alignment of texts against the libraries on whole texts."""
import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from edges import edge_documents

from sensorlake.llm import alignment as A
from sensorlake.llm import registry
from sensorlake.llm import words as W

P = pytest.importorskip("public_tokenizers")
PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
TEXTS = ["don't <|endoftext|>can't A\u0301 É Straße ﬁ ½ 10²  12,5% ...;x\n\n  y\n z \t w  ", "İstanbul x\u3000 y\xa0 z…  a \u2003 b", "'s 're 'sx", " ",
         "  ", "\n", "a▁b c▁ d", "▁", "x\x00y \x7f z <s> </s> <unk> <0x41>", "", None, "a " * 3_000, "b" * 5_000, "日本語 é W̊ 😀 👩‍👩‍👧"]


@pytest.fixture(scope="module")
def aligner():
    return A.Aligner(*PATHS)


def plain(aligner, texts):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    a, b = Tokenizer.from_file(PATHS[0]), SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    return brute.alignment(texts, lambda t: a.encode(t, add_special_tokens=False).ids, b.encode,
                           aligner.spell_a.tokens.__getitem__, aligner.spell_b.tokens.__getitem__)


@given(st.lists(st.tuples(st.lists(st.integers(1, 9), max_size=60), st.lists(st.integers(1, 9), max_size=9)), max_size=6))
def test_common_ends_are_those_of_the_sets(steps):
    a, b, base = [], [], 0
    for x, y in steps:
        a.append(base + np.cumsum(np.array(x, int)))
        b.append(base + np.cumsum(np.array(y, int)))
        base += sum(x) + sum(y)
    n_a, n_b = np.array([len(x) for x in a], int), np.array([len(y) for y in b], int)
    flat_a, flat_b = (np.concatenate([np.zeros(0, int), *x]) for x in (a, b))
    i, j = A.common_ends(flat_a, flat_b, n_a, n_b)
    assert flat_a[i].tolist() == flat_b[j].tolist() == [v for x, y in zip(a, b, strict=True) for v in sorted(set(x.tolist()) & set(y.tolist()))]


@given(st.lists(st.integers(0, 50), min_size=1, max_size=40), st.lists(st.tuples(st.integers(-1, 51), st.integers(-5, 45)), min_size=1, max_size=20))
def test_gallop_from_any_hint(table, asked):
    table = np.unique(table)
    keys, hint = (np.array(x) for x in zip(*asked, strict=True))
    low, high = np.zeros(len(keys), int), np.full(len(keys), len(table))
    assert A.gallop(table, keys, hint, low, high).tolist() == np.searchsorted(table, keys).tolist()


def test_texts_as_the_libraries_encode_them(aligner, monkeypatch):
    column = W.text_bytes(pa.array(TEXTS, pa.string()))
    for memory in (A.MEMORY_CHUNKS, 0):  # with and without what was remembered
        monkeypatch.setattr(A, "MEMORY_CHUNKS", memory)
        a, b, at_a, at_b, n_a, n_b = aligner.align(*column)
        n_groups = np.diff(np.searchsorted(at_a, np.append(0, np.cumsum(n_a))))
        raw, ends = A.group_texts((a, b, np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)), (n_a, n_b, n_groups), A.digit_table(50_257))
        want, _ = plain(aligner, list(enumerate(TEXTS)))
        import hashlib
        got = {i: (n_a[i], n_b[i], n_groups[i], hashlib.sha256(raw[ends[i]:ends[i + 1] - 1]).hexdigest() if n_a[i] else "") for i in range(len(TEXTS))}
        assert got == {i: (*w[:3], w[-1]) for i, w in want.items()}
        assert [w[0] for w in want.values()].count(0) == 4


@given(st.lists(st.text(st.sampled_from("a b\n\t\u00a0é▁'s<|>"), max_size=30), max_size=5))
def test_any_text(aligner, texts):
    a, b, at_a, at_b, n_a, n_b = aligner.align(*W.text_bytes(pa.array(texts, pa.string())))
    want, _ = plain(aligner, list(enumerate(texts)))
    n_groups = np.diff(np.searchsorted(at_a, np.append(0, np.cumsum(n_a))))
    assert [tuple(map(int, x)) for x in zip(n_a, n_b, n_groups, strict=True)] == [w[:3] for w in want.values()] and len(at_a) == len(at_b)


def test_linkable_pairs_by_hand():
    a, b = [b"x", b"ax", b"bax", b"", b"y"], [b"x", b"ax", b"zbax", b"x"]
    want = sum(bool(s and t) and (s.endswith(t) or t.endswith(s)) for s in a for t in b)
    assert A.linkable(a, b) == want


@pytest.mark.parametrize("folder", ["edge_dir", "odd_dir"])
def test_op13_against_plain_python(spark, aligner, folder, request):
    sf = request.getfixturevalue(folder)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want, linked = plain(aligner, list(enumerate(t for _, t in docs)))
    got = [tuple(r) for r in registry.queries()["op13_alignment"](spark, sf).collect()]
    assert sorted(got, key=str) == sorted([(i, *w) for (i, _), w in zip(docs, want.values(), strict=True)], key=str)
    assert len(linked) <= A.linkable(aligner.spell_a.tokens, aligner.spell_b.tokens)
    for x, y in linked:
        s, t = aligner.spell_a.tokens[x], aligner.spell_b.tokens[y]
        assert s.endswith(t) or t.endswith(s)


def test_counts_table_and_unpacked_lists(spark, aligner):
    texts = [(i, t) for i, (_, t, *_) in enumerate(edge_documents())]
    both = A.Tokenizers(*PATHS)
    aligned = A.align(spark.createDataFrame(texts, "doc_id long, text string").repartition(3), both)
    want, linked = plain(aligner, texts)
    assert {(r.a, r.b): r.n for r in A.link_counts(aligned, both).collect()} == dict(linked)
    for r in A.unpacked(aligned, both).collect():
        assert (len(r.a_ids), len(r.b_ids), len(r.a_sizes), len(r.b_sizes)) == (*want[r.doc_id][:2], want[r.doc_id][2], want[r.doc_id][2])
        assert sum(r.a_sizes) == len(r.a_ids) and sum(r.b_sizes) == len(r.b_ids)

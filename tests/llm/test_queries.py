"""Every opN query against plain Python on tables of edge cases, on empty tables, and on repeated rows and nulls."""
import hashlib
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from edges import edge_documents

from sensorlake.llm import registry

Q = registry.queries()
DOCS = [(i, t) for i, t, *_ in edge_documents()]


def tokenizer():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def rows(spark, name, folder):
    return Q[name](spark, folder).collect()


def test_op1_recall_ties_and_unusable_vectors(spark, edge_dir):
    table = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{edge_dir}/embeddings.parquet").collect() if r.vec_id < 400}
    got = brute.by(rows(spark, "op1_neighbours", edge_dir), "query_id")
    assert set(got) == {0, 100, 200, 300}  # 400 has no usable vector
    hits = 0
    for q, found in got.items():
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, 11))
        d = sorted((float(np.sqrt(((table[q] - v) ** 2).sum())), i) for i, v in table.items() if i != q)[:10]
        hits += len({i for _, i in d} & {r.vec_id for r in found})
        assert all(abs(r.score - np.sqrt(((table[q] - table[r.vec_id]) ** 2).sum())) < 1e-12 for r in found)
        assert found == sorted(found, key=lambda r: (r.score, r.vec_id))
    assert hits >= 36
    assert [r.vec_id for r in got[0]] == list(range(300, 310))  # equal vectors: the smaller ids


def test_op2_scores_every_row(spark, edge_dir):
    got = rows(spark, "op2_quality", edge_dir)
    assert sorted(r.doc_id for r in got) == [i for i, _ in DOCS]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) and r.held_out == brute.held_out(r.doc_id) for r in got)
    long = {i for i, t in DOCS if t and len(t) > 100}
    assert np.mean([(r.score > 0.5) == (r.doc_id in long) for r in got if r.held_out]) > 0.9


def test_op3_groups(spark, edge_dir):
    expected = brute.near_duplicates(DOCS, 85)
    got = rows(spark, "op3_near_duplicates", edge_dir)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert max(Counter(c for _, c in expected.values()).values()) > 6


def test_op3_null_and_repeated_ids(spark, odd_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{odd_dir}/documents.parquet").select("doc_id", "text").collect()]
    want, _ = brute.near_duplicate_rows(docs, 85)
    assert Counter(tuple(r) for r in rows(spark, "op3_near_duplicates", odd_dir)) == Counter(want)
    assert any(i is None and c is not None for i, _, c, _ in want) and any(i is None and c is None for i, _, c, _ in want)


def test_op4_mix(spark, edge_dir):
    got = rows(spark, "op4_mixing", edge_dir)
    size = {i: len(brute.WORD.findall(t or "")) for i, t in DOCS}
    assert {r.doc_id: r["size"] for r in got} == size
    per = Counter()
    for i, _, _, s, _ in edge_documents():
        per[s] += size[i]
    want = brute.targets(per)
    taken, largest = Counter(), Counter()
    for r in got:
        assert r.source_size == per[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken <= 2 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in want)
    assert sorted(rows(spark, "op4_mixing", edge_dir), key=str) == sorted(got, key=str)


def test_op5_shards(spark, edge_dir):
    got = rows(spark, "op5_sharding", edge_dir)
    text = dict(DOCS)
    shard_of = {}
    for r in got:
        raw = (text[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        assert shard_of.setdefault((text[r.doc_id] is None, raw), r.shard) == r.shard
    for shard, own in brute.by(got, "shard").items():
        assert 0 <= shard < 24 and sorted(r.slot for r in own) == list(range(len(own)))
    assert len(got) == len(DOCS)


def test_op6_token_file(spark, edge_dir):
    t, start = tokenizer(), 0
    got = {r.doc_id: r for r in rows(spark, "op6_tokens", edge_dir)}
    for i, text in DOCS:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_op7_spans(spark, edge_dir):
    got = {r.doc_id: r for r in rows(spark, "op7_secrets", edge_dir)}
    seen = Counter()
    for i, text in DOCS:
        spans = brute.secrets(text)
        kinds = Counter(s[3] for s in spans)
        seen += kinds
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert got[i].base_sha256 == hashlib.sha256(brute.span_text(spans).encode()).hexdigest()
        assert set(filter(None, brute.span_text(spans).split(","))) <= set(got[i].spans.split(","))
    assert set(seen) == {"assign", "access", "hex"}
    assert any("github" in r.spans for r in got.values())


def test_op8_codec(spark, edge_dir):
    t = tokenizer()
    got = {r.doc_id: r for r in rows(spark, "op8_bpe", edge_dir)}
    for i, text in DOCS:
        ids = t.encode(text or "", add_special_tokens=False).ids
        back = t.decode(ids, skip_special_tokens=False)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())


def test_op9_search(spark, edge_dir):
    want = brute.bm25(DOCS, {i: t for i, t in DOCS if i % 100 == 0})
    got = brute.by(rows(spark, "op9_search", edge_dir), "query_id")
    assert {q: [(r.doc_id, r.score) for r in sorted(own, key=lambda r: r["rank"])] for q, own in got.items()} == {q: x for q, x in want.items() if x}


def test_op10_repeats(spark, edge_dir):
    want = brute.repeats([(t or "").encode() for _, t in DOCS])
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows(spark, "op10_repeats", edge_dir)}
    assert [got[i] for i, _ in DOCS] == want


def test_op11_counts(spark, edge_dir):
    t = tokenizer()
    got = {r.doc_id: r for r in rows(spark, "op11_counts", edge_dir)}
    for i, text in DOCS:
        n = len(t.encode(text or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((text or "").encode()), n, n > 2048)
    assert {r.over_limit for r in got.values()} == {False, True}


@pytest.mark.parametrize("name", sorted(Q))
def test_empty_tables(spark, empty_dir, edge_dir, name):
    out = Q[name](spark, empty_dir)
    assert out.collect() == [] and out.schema.names == Q[name](spark, edge_dir).schema.names


@pytest.mark.parametrize("name", sorted(set(Q) - {"op1_neighbours", "op9_search", "op12_codes"}))
def test_repeated_rows_and_null_ids_are_all_returned(spark, odd_dir, name):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    assert Counter(r.doc_id for r in rows(spark, name, odd_dir)) == Counter(r.doc_id for r in docs.select("doc_id").collect())


def test_repeated_rows_search(spark, odd_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{odd_dir}/documents.parquet").where("doc_id is not null").collect()]
    want = brute.bm25(docs, {i: t for i, t in DOCS if i % 100 == 0})
    got = brute.by(rows(spark, "op9_search", odd_dir), "query_id")
    assert {q: [(r.doc_id, r.score) for r in sorted(own, key=lambda r: r["rank"])] for q, own in got.items()} == {q: x for q, x in want.items() if x}


def test_repeated_rows_neighbours(spark, odd_dir):
    got = brute.by(rows(spark, "op1_neighbours", odd_dir), "query_id")
    assert set(got) == {0, 100, 200, 300} and all(len(x) == 10 and all(r.vec_id != q for r in x) for q, x in got.items())


def test_repeated_rows_repeats(spark, odd_dir):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet").select("doc_id", "text").collect()
    want = brute.repeats([(r.text or "").encode() for r in docs])
    got = rows(spark, "op10_repeats", odd_dir)
    assert Counter((r.doc_id, *w) for r, w in zip(docs, want, strict=True)) == Counter(tuple(r) for r in got)

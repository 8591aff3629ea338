"""The cores of the operators on their own."""
import random
import re
import string
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorlake.llm import ann, bpe, gam, mixing, search, secrets, setsketch, sharding, suffix, tokenfile
from sensorlake.llm import words as W
from sensorlake.llm.components import connected_components
from sensorlake.llm.running import running_total


@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbB é\t\n\x0b\x1c ", max_size=30)), max_size=6))
def test_word_hashes_tell_words_apart(texts):
    hashes, ends = W.word_hashes(*W.text_bytes(pa.array(texts, pa.string())))
    mine = [brute.words(t) for t in texts]
    assert np.diff(ends).tolist() == [len(w) for w in mine]
    flat = [w for own in mine for w in own]
    assert len(set(zip(flat, hashes.tolist(), strict=True))) == len(set(flat)) == len(set(hashes.tolist()))


def test_running_total(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.randint(0, 3), rng.randint(0, 3), i, rng.randint(0, 5)) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, a int, b int, i int, v long")
    got = {r.i: r.before for r in running_total(df, "v", ["g"], [["a"], ["b"]], ["i"]).collect()}
    for g in "ab":
        total = 0
        for _, _, _, i, v in sorted(r for r in rows if r[0] == g):
            assert got[i] == total
            total += v


def test_components_of_a_long_chain(spark):
    keys = [b"%04d" % i for i in range(60)]
    links = spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in zip(keys, keys[1:], strict=False) if a != b"0030"], "a binary, b binary")
    got = {bytes(r.key): bytes(r.label) for r in connected_components(links).collect()}
    assert got == {k: (b"0000" if k <= b"0030" else b"0031") for k in keys}


# ---- sharding ---------------------------------------------------------------------------

@given(st.lists(st.integers(0, 50), max_size=12), st.integers(1, 5))
@settings(max_examples=80)
def test_capacity_is_the_smallest(sizes, shards):
    edges = [0, *np.cumsum(sizes, dtype=int).tolist()]
    c = sharding.smallest_capacity(edges, shards)
    assert c == brute.capacity(sizes, shards)
    cuts = [0, *sharding.even_cuts(edges, c, shards), len(edges) - 1]
    assert cuts == sorted(cuts) and max(edges[b] - edges[a] for a, b in zip(cuts, cuts[1:], strict=False)) <= c


def test_cuts_by_refinement_equal_a_search_over_all_groups(spark):
    rng = random.Random(2)
    rows = [("".join(rng.choice("0123") for _ in range(32)), rng.randint(1, 500)) for _ in range(400)]
    capacity, cuts = sharding.contiguous_cuts(spark.createDataFrame(rows, "key string, size long"), 9)
    sizes = [s for _, s in sorted(rows)]
    assert capacity == sharding.smallest_capacity([0, *np.cumsum(sizes).tolist()], 9)
    keys = sorted(k for k, _ in rows)
    load = [0] * 9
    for k, s in rows:
        load[sum(k >= c for c in cuts)] += s
    assert max(load) <= capacity and len(cuts) == 8 and keys


def test_a_hot_text_fills_a_shard_of_its_own(spark):
    rows = [(i, "hot " * 50) for i in range(100)] + [(1000 + i, f"text {i} " * 5) for i in range(300)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 6).collect()
    load = {s: sum(r["size"] for r in own) for s, own in brute.by(got, "shard").items()}
    assert {r.shard for r in got if r.doc_id < 100} == {0}
    rest = [v for s, v in load.items() if s]
    assert len(rest) == 5 and max(rest) < 1.1 * min(rest)


# ---- mixing -------------------------------------------------------------------------------

def test_mix_emits_whole_rows_as_often_as_counted(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(0, 30), rng.choice(["a", "b", None]), i) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")
    counts = {r.row.doc_id: r.copies for r in mixing.mix_counts(docs).collect()}
    out = mixing.mix(docs).collect()
    assert docs.columns == list(out[0].asDict()) and max(counts.values()) <= 2
    assert {i: sum(r.doc_id == i for r in out) for i in counts} == counts


@given(st.dictionaries(st.sampled_from([None, *"abcdefg"]), st.integers(0, 1000), min_size=1))
@settings(max_examples=5, deadline=None)
def test_targets_by_level_equal_targets_by_resharing(spark_session, sizes):
    rows = [(s is not None, s or "", n) for s, n in sizes.items()]
    got = mixing.source_targets(spark_session.createDataFrame(rows, "_has_source boolean, _source string, size long")).collect()
    want = brute.targets(sizes)
    for r in got:
        assert r.target == pytest.approx(want[r._source if r._has_source else None], abs=1e-6)


@pytest.fixture(scope="session")
def spark_session(spark):
    return spark


# ---- secrets ----------------------------------------------------------------------------------

def test_trigram_queries_never_miss():
    rng = random.Random(4)
    texts = {"assign": ["PassWord = 'abcdefghijkl", "API_KEY:aaaaaaaaaaaa", "apikey\": zzzzzzzzzzzz"], "access": ["AKIA" + "X9" * 8], "github": ["ghs_" + "a" * 40],
             "slack": ["xoxb-1234567890ab"], "pem": ["-----BEGIN RSA PRIVATE KEY-----"], "jwt": ["eyJhbGciOiJI.eyJzdWIiOiIx.abcdefghij"]}
    for rule in secrets.BASE + secrets.MORE:
        query = secrets.trigram_query(rule.pattern)
        for text in texts.get(rule.kind, []):
            assert re.search(rule.pattern, text)
            low = ("".join(rng.choices(string.printable, k=20)) + text).lower()
            assert any(all(t in low for t in c) for c in query)
    assert secrets.trigram_query(secrets.BASE[2].pattern) is None
    assert secrets.trigram_query("ab|abc") is None and secrets.trigram_query("(abc|bcd)x?") == [frozenset({"abc"}), frozenset({"bcd"})]
    assert secrets.trigram_query("ab*cde") == [frozenset({"cde"})] and secrets.trigram_query("(?:abc)+d*") == [frozenset({"abc"})]


def test_masking(spark):
    rows = [(1, "é token = abcdefabcdefabcdef0123 end"), (2, "nothing"), (3, None), (4, "AKIA" + "A" * 16 + "é" + "deadbeef" * 3)]
    found = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r[0]: r[1] for r in found.select("row.doc_id", secrets.masked(F.col("row.text"), F.col("spans"))).collect()}
    assert got == {1: "é [assign] end", 2: "nothing", 3: None, 4: "[access]é[hex]"}


# ---- sketches ---------------------------------------------------------------------------------

def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    for common, a, b in ((400, 50, 50), (100, 300, 300), (500, 0, 200)):
        h = rng.integers(0, 1 << 63, common + a + b, dtype=np.uint64)
        sets = h[:common + a], np.concatenate([h[:common], h[common + a:]])
        regs = [setsketch.registers(s, np.array([0, len(s)])) for s in sets]
        whole = setsketch.registers(np.unique(np.concatenate(sets)), np.array([0, len(h)]))
        assert (setsketch.merge(*regs) == whole).all()
        j = setsketch.similarity(*regs, np.array([len(sets[0])]), np.array([len(sets[1])]))[0]
        assert abs(j - common / len(h)) < 0.12


@pytest.mark.parametrize("large, block", [(32, 256), (2, 3)])
def test_large_buckets_give_the_same_groups(spark, monkeypatch, large, block):
    rng = random.Random(7)
    base = [f"w{rng.randint(0, 500)}" for _ in range(60)]
    rows = []
    for i in range(70):
        w = list(base)
        for j in rng.sample(range(60), rng.randint(0, 2)):
            w[j] = f"x{rng.randint(0, 20)}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(setsketch, "LARGE", large)
    monkeypatch.setattr(setsketch, "BLOCK", block)
    got = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near_duplicates(rows, 85)


# ---- nearest neighbours -----------------------------------------------------------------------

def test_graph_recall_and_degree():
    v = np.random.default_rng(2).normal(size=(1500, 24))
    graph = ann.Graph(v).build()
    assert (graph.edges >= 0).sum(1).max() <= ann.DEGREE + ann.SLACK
    q = v[:100]
    found, _ = graph.search(q.astype(np.float32), 64)
    true = np.argsort(((q[:, None] - v[None]) ** 2).sum(2), 1)[:, :10]
    assert np.mean([len(set(a) & set(b[:10])) / 10 for a, b in zip(true, found, strict=True)]) > 0.95


def test_shards_meet_all_queries(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 50)
    rng = np.random.default_rng(3)
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.normal(size=(400, 6)))], "vec_id long, embedding array<double>")
    vectors = ann.vectors_of(table)
    shards = ann.shard_count(vectors)
    assert shards == 9
    got = ann.search(ann.build_index(vectors, shards), vectors.where("vec_id < 20"), shards, k=5).collect()
    v = np.array([r.embedding for r in table.orderBy("vec_id").collect()])
    hits = 0
    for q, own in brute.by(got, "query_id").items():
        d = ((v - v[q]) ** 2).sum(1)
        d[q] = np.inf
        hits += len(set(np.argsort(d)[:5].tolist()) & {r.vec_id for r in own})
    assert hits >= 95


# ---- classifier ----------------------------------------------------------------------------------

def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(4)
    x = rng.uniform(size=(4000, len(gam.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.fit(x[:3000], y[:3000])
    assert {0, 1} in [set(p) for p in model.pairs]
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95


def test_one_label_or_none():
    x = np.zeros((5, len(gam.FEATURES)))
    assert gam.fit(x[:0], np.zeros(0)).score(x).tolist() == [0.5] * 5
    assert gam.fit(x, np.ones(5)).score(x).min() > 0.99


def test_features_of_known_texts():
    x = gam.features(*W.text_bytes(pa.array(["", None, "AB ab ab\nab 1", "a## !!"])))
    at = {f: i for i, f in enumerate(gam.FEATURES)}
    assert np.isfinite(x).all() and (x[0] == x[1]).all()
    assert x[2, at["upper"]] == pytest.approx(2 / 13) and x[2, at["repeated_next"]] == pytest.approx(3 / 5) and x[2, at["letterless_words"]] == pytest.approx(1 / 5)
    assert x[3, at["symbol_ends"]] == 1 and x[3, at["capital_words"]] == 0


# ---- token files --------------------------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 5, 100, 3000])
def test_perfect_hash_is_minimal_and_refuses_foreign_keys(n):
    keys = np.zeros(n, tokenfile._KEY)
    keys["doc_id"] = np.random.default_rng(n).choice(1 << 40, n, replace=False)
    h = tokenfile.key_hashes(keys)
    seeds = tokenfile.build_hash(h)
    at = tokenfile.slots_of(h, seeds, n)
    assert sorted(at.tolist()) == list(range(n))
    slots = np.zeros(n, tokenfile._SLOT)
    slots["fingerprint"][at], slots["length"][at], slots["offset"][at] = tokenfile.fingerprints(h), 1, np.arange(n)
    ids = np.arange(n, dtype="<u4")
    segment = tokenfile.Segment({"payload": ids.tobytes(), "width": 4, "seeds": seeds.tobytes(), "slots": slots.tobytes(), "keys": keys.tobytes()})
    assert all(segment.get(int(k)) == [i] for i, k in enumerate(keys["doc_id"]))
    assert sum(segment.get(-1 - i) is not None for i in range(100)) == 0


# ---- codec ---------------------------------------------------------------------------------------

@given(st.dictionaries(st.binary(min_size=1, max_size=6), st.lists(st.integers(0, 99), max_size=3), max_size=40))
def test_lexicon_maps_words_to_ids(entries):
    lexicon = bpe.Lexicon(bpe.Lexicon.build(entries))
    words = [*entries, b"", b"\xff" * 7, b"zzz" * 20]
    at = lexicon.find(words)
    for w, p in zip(words, at.tolist(), strict=True):
        assert (p >= 0) == (w in entries)
        if p >= 0:
            assert lexicon.ids[lexicon.offsets[p]:lexicon.offsets[p + 1]].tolist() == entries[w]


def test_lexicon_shares_suffixes():
    words = {a + b: [1] for a in (b"aa", b"bb", b"cc") for b in (b"ing", b"ed", b"s")}
    assert bpe.Lexicon(bpe.Lexicon.build(words)).n_states <= 11


def test_codec_equals_the_library_on_odd_texts():
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    from tokenizers import Tokenizer
    library, rng = Tokenizer.from_file(path), random.Random(8)
    pools = [string.printable, "aAbs'tTlLdD.,!?<|>é́ \n#*ßÀW̊", "".join(map(chr, range(32, 0x250))), "".join(map(chr, range(0x300, 0x3000, 7))) + "日本🎞👍🏽‍ "]
    texts = [None, "", " ", "<|endoftext|>a<|ENDOFTEXT|>", "x" * 5000, "don't I'LL", "ſ K İ ΣΑΣ"] + ["".join(rng.choices(p, k=60)) for p in pools for _ in range(150)]
    vocabulary = bpe.Vocabulary(path)
    ids, counts = vocabulary.encode_words([b"the", b"and"])
    lexicon = bpe.Lexicon(bpe.Lexicon.build({b"the": ids[:counts[0]].tolist(), b"and": ids[counts[0]:].tolist()}))
    for encoder in (bpe.Encoder(vocabulary, lexicon), tokenfile.LibraryEncoder(path)):
        got, n = encoder.encode(*W.text_bytes(pa.array(texts)))
        ends = np.cumsum(n)
        for text, a, b in zip(texts, ends - n, ends, strict=True):
            want = library.encode(text or "", add_special_tokens=False).ids
            assert got[a:b].tolist() == want, repr(text)
            assert vocabulary.decode(got[a:b]) == library.decode(want, skip_special_tokens=False)


# ---- search -----------------------------------------------------------------------------------------

def test_blocks_are_skipped_without_loss(spark, monkeypatch):
    rng = random.Random(9)
    docs = [(i, " ".join(f"w{int(rng.paretovariate(0.6)) % 900}" for _ in range(rng.randint(1, 60)))) for i in range(900)]
    index = search.Index.build(spark.createDataFrame(docs, "doc_id long, text string"))
    shard = search.Shard(index.shards.collect()[0].asDict(), index.mean_length)
    frequency = {r.term: r.documents for r in index.frequencies.collect()}
    queries = {1_000_000 + i: " ".join(f"w{rng.randint(100, 899)}" for _ in range(3)) for i in range(40)}
    want, total = brute.bm25(docs, queries, k=5), 0
    for q, text in queries.items():
        _, terms, _, _ = search.term_counts(*W.text_bytes(pa.array([text])))
        known = np.array([t for t in terms.tolist() if np.uint64(t).astype(np.int64).item() in frequency], np.uint64)
        df = np.array([frequency[np.uint64(t).astype(np.int64).item()] for t in known.tolist()], float)
        [(ids, scores)] = shard.top([(q, known, np.log1p((900 - df + 0.5) / (df + 0.5)))], 5)
        assert list(zip(ids.tolist(), scores.tolist(), strict=True)) == want[q]
        total += shard.blocks
    assert shard.scored < 0.8 * total


def test_queries_meet_shards_without_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(search, "SHARD_BYTES", 8 << 10)
    monkeypatch.setattr(search, "GROUP_TERMS", 2000)
    rng = random.Random(10)
    docs = [(i, " ".join(f"w{int(rng.paretovariate(0.5)) % 700}" for _ in range(rng.randint(1, 80)))) for i in range(500)]
    docs += docs[:20] + [(1000 + i, docs[40][1]) for i in range(30)]  # repeated rows, and ties for the last ranks
    table = spark.createDataFrame(docs, "doc_id long, text string")
    index = search.Index.build(table)
    assert index.count > 8
    found = index.search(table.where("doc_id % 10 = 0"), k=7)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[plan.index("CartesianProduct"):]  # queries x shards come to no disk
    got = {q: [(r.doc_id, r.score) for r in sorted(own, key=lambda r: r["rank"])] for q, own in brute.by(found.collect(), "query_id").items()}
    assert got == brute.bm25(docs, {i: t for i, t in docs if i % 10 == 0}, k=7)


def test_groups_hold_every_query_once(monkeypatch):
    monkeypatch.setattr(search, "GROUP_TERMS", 1000)
    rng = np.random.default_rng(11)
    lengths = [1] * 40 + [1500, 10, 30, 2500, 900, 900] + rng.integers(1, 200, 50).tolist()
    idf = rng.uniform(0, 12, 5000)
    asked = {i: np.sort(rng.choice(5000, n, replace=False)) for i, n in enumerate(lengths)}
    kind = pa.list_(pa.struct([("term", pa.int64()), ("idf", pa.float64())]))
    rows = [pa.RecordBatch.from_arrays([pa.array([i for i, _ in some], pa.int64()), pa.array([[{"term": t - 2500, "idf": idf[t]} for t in own.tolist()] for _, own in some], kind)],
                                       ["query_id", "words"]) for some in (list(asked.items())[:45], list(asked.items())[45:], [])]
    seen = {}
    for group in search._groups(iter(rows)):
        queries, starts, places, words, weights = (np.frombuffer(c[0].as_buffer(), t) for c, t in zip(group.columns, ("<i8", "<i4", "<i4", "<u8", "<f8"), strict=True))
        assert len(queries) == 1 or len(places) + search.QUERY_TERMS * len(queries) <= 1000
        assert (np.diff(words.astype(object)) > 0).all()
        for q, a, b in zip(queries.tolist(), starts[:-1], starts[1:], strict=True):
            assert q not in seen
            seen[q] = sorted(zip(words[places[a:b]].view(np.int64).tolist(), weights[places[a:b]].tolist(), strict=True))
    assert seen == {i: [(t - 2500, idf[t]) for t in own.tolist()] for i, own in asked.items()}


def test_one_pass_over_the_lists_equals_blocks(spark, monkeypatch):
    rng = random.Random(12)
    docs = [(i, " ".join(f"w{int(rng.paretovariate(0.4)) % 900}" for _ in range(rng.randint(1, 60)))) for i in range(1500)]
    docs += docs[:50] + [(3000 + i, docs[60][1]) for i in range(40)]
    index = search.Index.build(spark.createDataFrame(docs, "doc_id long, text string"))
    row, frequency = index.shards.collect()[0].asDict(), {r.term: r.documents for r in index.frequencies.collect()}
    answers = []
    for dense in (0, np.inf):
        monkeypatch.setattr(search, "DENSE", dense)
        shard = search.Shard(row, index.mean_length)
        queries = []
        for i, text in [docs[j] for j in (0, 3, 60, 61, 700, 1400)] + [(-1, "w1 w2 nothing"), (-2, "")]:
            _, terms, _, _ = search.term_counts(*W.text_bytes(pa.array([text])))
            df = np.array([frequency.get(t, 1) for t in terms.view(np.int64).tolist()], float)
            queries.append((i, terms, np.log1p((len(docs) - df + 0.5) / (df + 0.5))))
        answers.append([list(zip(ids.tolist(), scores.tolist(), strict=True)) for ids, scores in shard.top(queries, 10)])
    assert answers[0] == answers[1] and [len(x) for x in answers[0]] == [10] * 7 + [0]


# ---- suffix arrays ------------------------------------------------------------------------------------

@given(st.lists(st.binary(min_size=1, max_size=30).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=8, unique=True))
@settings(max_examples=60)
def test_suffix_array_and_common_prefixes(strings):
    data = np.frombuffer(b"".join(strings), np.uint8)
    lengths = np.array([len(s) for s in strings])
    stops = np.cumsum(lengths)
    ends = np.repeat(stops, lengths)
    order = suffix.suffix_array(data, ends)
    suffixes = [data[i:ends[i]].tobytes() for i in range(len(data))]
    assert [suffixes[i] for i in order] == sorted(suffixes)
    shared = suffix.common_prefixes(data, ends, stops - lengths, order)
    for a, b in zip(order, order[1:], strict=False):
        x, y = suffixes[a], suffixes[b]
        assert shared[b] == next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))


def test_pieces_cover_every_window_once():
    rng = random.Random(10)
    texts = ["".join(rng.choice("abc") for _ in range(n)) for n in (0, 199, 200, 201, 1500)] + ["ab" * 900]
    data, offsets = W.text_bytes(pa.array(texts))
    owner, begin, count, _, times = suffix.pieces_of(data, offsets)
    seen = [[0] * max(0, len(t) - 199) for t in texts]
    for o, b, c in zip(owner, begin, count, strict=True):
        for p in range(b, b + c):
            seen[o][p] += 1
    assert all(set(s) <= {1} for s in seen) and (times[owner == 5] == 2).all()


@pytest.mark.parametrize("most", [1, 2, 1024])
def test_hot_anchors_are_merged_across_shards(spark, monkeypatch, most):
    monkeypatch.setattr(suffix, "SHARD_BYTES", 2000)
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    passage = " ".join(word() for _ in range(70))
    texts = [" ".join(word() for _ in range(20)) + passage[k:] + " ".join(word() for _ in range(20)) for k in range(0, 120, 9)] + ["xy " * 200] * 2 + ["xy " * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.remove_repeats(docs, most=most).collect()}
    assert [got[i] for i in range(len(texts))] == brute.repeats([t.encode() for t in texts])


# ---- quality ---------------------------------------------------------------------------------------

def test_an_id_with_many_rows_is_one_row_of_the_fit(spark, monkeypatch):
    monkeypatch.setattr(gam, "fit", lambda x, y: (x, y))
    ids = [i for i in range(40) if not brute.held_out(i)]
    rows = [(i, f"text number {i}") for i in range(40)] + [(ids[0], t) for t in [None, "z" * 50, *["many"] * 500]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in ids] + [(ids[0], 1)], "doc_id long, quality int")
    x, y = gam.train(docs, labels)
    assert len(x) == len(y) == len(ids) + 1
    want = gam.features(*W.text_bytes(pa.array(["many" if i == ids[0] else f"text number {i}" for i in [*ids, ids[0]]])))
    assert sorted(map(tuple, x)) == sorted(map(tuple, want))
    assert len(gam.train(docs, labels, most=5)[1]) == 5


def test_mix_of_rows_that_share_an_id_is_the_same_on_every_run(spark):
    rows = [(i, f"word{k} b c", "s") for k in range(200) for i in (7, None)] + [(k, "a " * 20, "t") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    runs = [Counter((r.doc_id, r.text, r.source) for r in mixing.mix(docs.repartition(n, *by)).collect()) for n, by in ((2, []), (5, ["text"]), (1, []))]
    assert runs[0] == runs[1] == runs[2] and len(set(runs[0].values())) > 1


def test_lookup_over_many_segments(spark, monkeypatch):
    """Ids that lie in several segments, foreign ids, null and repeated keys."""
    public_tokenizers = pytest.importorskip("public_tokenizers")
    monkeypatch.setattr(tokenfile, "PARTITION_BYTES", 4_000)
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [(5, f"the same id {i} " * 3) for i in range(14)] + [(None, "without an id")] * 3 + [(i * 10, f"text {i}") for i in range(300)] + [(7, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    segments = tokenfile.write_tokens(docs.repartition(3), path)
    assert segments.count() > 3
    found = tokenfile.lookup(segments, spark.createDataFrame([(i,) for i in (5, 5, 0, 7, 9, 1500, 2990, 3, 11, -4, 10 ** 12, None)], "doc_id long")).collect()
    from tokenizers import Tokenizer
    encode = lambda t: [*Tokenizer.from_file(path).encode(t or "", add_special_tokens=False).ids, 1]
    got = Counter((r.doc_id, tuple(r.ids)) for r in found)
    assert got == Counter((i, tuple(encode(t))) for i, t in rows if i in (5, 0, 7, 9, 1500, 2990))
    assert len({(r.part, r.seq, r.copy) for r in found if r.doc_id == 5}) == 14
    row = segments.where("least <= 1500 and greatest >= 1500").first().asDict()
    assert tokenfile.Segment(row).get(1500).tolist() == encode("text 150") and tokenfile.Segment(row).get(1501) is None


def test_token_file_of_empty_texts_is_spread(spark, monkeypatch):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    monkeypatch.setattr(tokenfile, "PARTITION_BYTES", 20_000)
    docs = spark.createDataFrame([(i % 2, "") for i in range(3_000)], "doc_id long, text string").repartition(4)
    segments = tokenfile.write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    sizes = [r.n_docs for r in segments.collect()]
    assert sum(sizes) == 3_000 and max(sizes) < 1_000
    assert sorted(r.start for r in tokenfile.read_documents(segments).collect()) == list(range(3_000))


def test_a_common_passage_meets_once_for_each_shard():
    rng = np.random.default_rng(3)
    passage = bytes(rng.integers(97, 123, 400, dtype=np.uint8))
    pieces = [bytes(rng.integers(97, 123, 50, dtype=np.uint8)) + passage for _ in range(200)]
    table = pa.table({"key": pa.array([bytes([i]) for i in range(200)], pa.binary()), "begin": pa.array([0] * 200, pa.int32()), "n": pa.array([10 ** 6] * 200, pa.int64()),
                      "shard": pa.array([0] * 200, pa.int32()), "piece": pa.array(pieces, pa.binary())})
    found = suffix._search_shard(table, 10, 3)
    prints = np.concatenate([np.frombuffer(x, suffix._PRINT) for x in found.column("prints").to_pylist() if x is not None])
    sure = np.concatenate([np.frombuffer(x, bool) for x in found.column("sure").to_pylist() if x is not None])
    windows = Counter(p[i:i + suffix.LENGTH] for p in pieces for i in range(len(p) - suffix.LENGTH + 1))
    assert len(np.unique(prints)) == len(prints) == len(windows) and sure.sum() == sum(n > 1 for n in windows.values())


def test_decode_gives_what_encode_decoded(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    docs = spark.createDataFrame([(1, "Some words, 12 and é"), (2, ""), (3, None), (None, "<|endoftext|> x"), (1, "Some words, 12 and é")], "doc_id long, text string")
    codec = bpe.Codec.compile(docs, public_tokenizers.path("word_bpe_49k.json"))
    done = codec.encode(docs, decoded=True).collect()
    back = codec.decode(codec.encode(docs)).collect()
    assert sorted(map(tuple, back), key=str) == sorted(map(tuple, done), key=str) and len(back) == 5
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert all(r.decoded == library.decode(r.ids, skip_special_tokens=False) for r in back)

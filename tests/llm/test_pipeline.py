"""The pipeline's stages, each against plain Python on its own input."""
from collections import Counter

import brute
import pytest

import corpus_pipeline as P
from sensorlake.llm import gam, mixing
from sensorlake.llm.scratch import pin


@pytest.mark.parametrize("folder", ["edge_dir", "odd_dir"])
def test_stages(spark, folder, request):
    sf = request.getfixturevalue(folder)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(P.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "secret_scan", "mix", "tokens"]

    model = gam.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    good = pin(stages["quality"](spark, docs, sf))
    scores = gam.score(docs, model).collect()
    assert good.columns == P.COLUMNS
    assert Counter(r.doc_id for r in good.collect()) == Counter(r.row.doc_id for r in scores if r.score >= P.KEEP)

    single = pin(stages["near_duplicates"](spark, good, sf))
    rows = [(r.doc_id, r.text) for r in good.collect()]
    _, groups = brute.near_duplicate_rows(rows, 80)
    worded = [(i is None, i, g) for (i, t), g in zip(rows, groups, strict=True) if brute.words(t)]
    least = {g: min(x[:2] for x in worded if x[2] == g) for g in {x[2] for x in worded}}
    want = Counter(i for _, i in least.values()) + Counter(i for i, _ in {x for x in rows if not brute.words(x[1])})
    assert single.columns == P.COLUMNS and Counter(r.doc_id for r in single.collect()) == want

    clean = pin(stages["secret_scan"](spark, single, sf))
    before = Counter((r.doc_id, r.lang, r.source) for r in single.collect())
    after = clean.collect()
    assert clean.columns == P.COLUMNS and Counter((r.doc_id, r.lang, r.source) for r in after) == before
    text = {r.doc_id: r.text for r in single.collect()}
    for r in after:
        assert not brute.secrets(r.text) and r.n_chars == (None if r.text is None else len(r.text))
        if r.doc_id is not None and "[" not in (r.text or ""):
            assert r.text == text[r.doc_id]

    mixed = pin(stages["mix"](spark, clean, sf))
    counts = Counter()
    for r in mixing.mix_counts(clean).collect():
        counts[r.row.doc_id] += r.copies
    assert mixed.columns == P.COLUMNS and Counter(r.doc_id for r in mixed.collect()) == +counts

    ids = stages["tokens"](spark, mixed, sf).collect()
    assert Counter(r.doc_id for r in ids) == +counts and all(r.ids is not None for r in ids)


def test_run_on_empty_tables(spark, empty_dir):
    assert P.run(spark, empty_dir).collect() == []


def test_rows_that_share_an_id_go_by_their_texts(spark):
    words = [f"w{i}" for i in range(80)]
    a, near, b, c = " ".join(words), " ".join([*words[:-1], "other"]), "zz " + " ".join(words[::-1]), "another text under the same id"
    rows = [(3, a), (7, a), (7, near), (7, b), (7, b.upper()), (7, b), (7, c), (7, None), (7, None), (7, ""), (8, c), (8, ""), (9, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = Counter((r.doc_id, r.text) for r in P.near_duplicates(spark, docs.repartition(3), "").collect())
    assert got == Counter([(3, a), (7, b.upper()), (7, c), (7, None), (7, ""), (8, ""), (9, None)])


def test_null_ids_link_and_go_like_others(spark):
    words = [f"w{i}" for i in range(100)]
    near, far = [*words[:92], *(f"x{i}" for i in range(8))], [*(f"y{i}" for i in range(4)), *words[4:92], *(f"x{i}" for i in range(8))]
    first, near, far = " ".join(words), " ".join(near), " ".join(far)  # first and far are linked by way of near only
    alone = "alone without an id here"
    rows = [(1, first), (None, near), (2, far), (None, near), (None, alone), (None, alone)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = Counter((r.doc_id, r.text) for r in P.near_duplicates(spark, docs.repartition(2), "").collect())
    assert got == Counter([(1, first), (None, alone)])

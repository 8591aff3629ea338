"""Accuracy on the driver's tables: recall of the neighbours, held-out quality, groups of a larger table."""
import os

import numpy as np
import pytest

from sensorlake.llm import registry

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
Q = registry.queries()


def test_neighbours_recall(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    v, ids = np.array([r.embedding for r in rows], float), np.array([r.vec_id for r in rows])
    hits = total = 0
    got = {}
    for r in Q["op1_neighbours"](spark, SF).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    for i in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((v - v[i]) ** 2).sum(1))
        d[i] = np.inf
        hits += len(set(ids[np.lexsort((ids, d))[:10]].tolist()) & got[int(ids[i])])
        total += 10
    assert hits / total >= 0.95


def test_quality_of_held_out_documents(spark):
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(r.score, label[r.doc_id]) for r in Q["op2_quality"](spark, SF).collect() if r.held_out and r.doc_id in label]
    good, bad = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    assert good and bad
    auc = np.mean([[(g > b) + 0.5 * (g == b) for b in bad] for g in good])
    assert auc > 0.97 and np.mean([(s >= 0.7) == y for s, y in held]) > 0.95

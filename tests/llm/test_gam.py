"""The additive model against boosting by plain loops."""
import brute
import numpy as np
import pytest

from sensorlake.llm import gam


@pytest.mark.parametrize("seed", range(3))
def test_fit_and_score_against_plain_boosting(monkeypatch, seed):
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(gam, "FEATURES", ("a", "b", "c", "d"))
    for name, value in (("BINS", 8), ("PAIR_BINS", 4), ("PAIRS", 2), ("ROUNDS", 5), ("PAIR_ROUNDS", 3)):
        monkeypatch.setattr(gam, name, value)
    x = rng.normal(size=(150, 4))
    x[:, 3] = np.round(x[:, 3])  # ties
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=150) > 0).astype(float)
    model = gam.fit(x, y)
    bins = gam.binned(x, model.edges)
    want = brute.additive_model(bins.tolist(), y.tolist(), 8, 5, gam.LEAVES, gam.RATE, 4, 3, 2)
    assert np.allclose(model.score(x), want, atol=1e-9)
    assert len(model.pairs) == 2 and np.mean((model.score(x) > 0.5) == y) > 0.65


def test_score_adds_the_entries_of_its_bins(monkeypatch):
    monkeypatch.setattr(gam, "FEATURES", ("a", "b"))
    table = np.zeros((2, gam.BINS))
    table[0, 0], table[0, 1], table[1, 1] = -1.0, 0.5, 0.25
    pair = np.zeros((gam.PAIR_BINS, gam.PAIR_BINS))
    pair[0, 0] = 2.0
    model = gam.Model(0.1, [np.array([1.0]), np.array([5.0])], table, [(1, 0)], [pair])
    got = model.score(np.array([[0.0, 0.0], [1.0, 0.0], [3.0, 9.0]]))
    assert np.allclose(got, 1 / (1 + np.exp(-np.array([1.1, 2.6, 2.85]))))

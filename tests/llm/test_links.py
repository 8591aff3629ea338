"""Links of near copies: in proportion to a group's classes, and no component lost."""
import random

import brute
import pytest

from sensorlake.llm import setsketch


def copies(n, seed=1, length=120, other=0.04):
    """Near copies of one text, most of them linked with most others, and unrelated texts."""
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(length)]
    out = []
    for i in range(n):
        w = list(base)
        for j in rng.sample(range(length), rng.randint(0, 3 if i % 9 else 6)):
            w[j] = f"z{rng.randint(0, 10 ** 6)}"
        out.append((i, " ".join(w)))
    return out + [(n + i, " ".join(f"u{rng.randint(0, 99)}" for _ in range(30))) for i in range(int(other * n))]


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def components(spark, rows, percent):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in setsketch.near_duplicates(table(spark, rows), percent).collect()}


@pytest.mark.parametrize("percent", [80, 85, 93])
def test_components_of_a_large_group(spark, percent):
    rows = copies(400)
    assert components(spark, rows, percent) == brute.near_duplicates(rows, percent)


def test_components_when_buckets_hold_several_groups(spark, monkeypatch):
    monkeypatch.setattr(setsketch, "LARGE", 4)
    monkeypatch.setattr(setsketch, "BLOCK", 16)
    rows = copies(150)
    for percent in (80, 88, 95):
        assert components(spark, rows, percent) == brute.near_duplicates(rows, percent)


def test_links_grow_with_the_classes(spark, monkeypatch):
    seen = []
    joined = setsketch.connected_components
    monkeypatch.setattr(setsketch, "connected_components", lambda links: (seen.append(links.distinct().count()), joined(links))[1])
    for n in (300, 1200):
        components(spark, copies(n), 80)
    assert seen[0] + seen[1] <= 1.5 * 312 and seen[2] + seen[3] <= 1.5 * 1248  # classes: 300 and 1200 copies, 12 and 48 others

"""The links of the n-gram Jaccard join, against all pairs."""

import random
from collections import Counter

import pytest

from rewardlake.llm import jaccard


@pytest.mark.parametrize("unit_sets", [1024, 4])
def test_all_links(spark, monkeypatch, unit_sets):
    """Cliques, a chain, equal texts and empty ones, in one unit and in many."""
    monkeypatch.setattr(jaccard, "UNIT_SETS", unit_sets)
    rng, texts = random.Random(3), ["", " ", "alone in the world"]
    for _ in range(4):
        base = [f"w{rng.randint(0, 9_999)}" for _ in range(80)]
        texts += [" ".join(base[:k] + [f"x{k}"] + base[k + 1:]) for k in range(0, 78, 7)]
        texts += [" ".join(base)] * 3
    chain = [f"c{i}" for i in range(200)]
    texts += [" ".join(chain[8 * i:8 * i + 100]) for i in range(12)]
    link = jaccard.Link(3, 8, 10)
    sets = [frozenset(tuple(t.split()[k:k + 3]) for k in range(len(t.split()) - 2)) for t in texts]
    near = {(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and
            10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows, links = jaccard.joined(spark, df, link)
    rows = {r["doc_id"]: r for r in rows.collect()}
    want = Counter(x for pair in near for x in pair)
    assert {i: r["n_links"] for i, r in rows.items()} == {i: want[i] for i in range(len(texts))}
    got = Counter(frozenset((u, v)) for u, v in links.collect())
    assert got == Counter({frozenset((rows[a]["sid"], rows[b]["sid"])) for a, b in near if sets[a] != sets[b]})
    chained = list(range(len(texts) - 12, len(texts)))
    assert [want[i] for i in chained] == [1] + [2] * 10 + [1] and len({rows[i]["class"] for i in chained}) == 1

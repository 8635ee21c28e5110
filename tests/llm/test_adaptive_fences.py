"""Fences that a bad minority of a group cannot move."""

import random

import pytest

from rewardlake.llm import quality_rules


@pytest.mark.parametrize("junk", ["symbol", "lines", "upper", "long", "short"])
def test_one_third_junk(spark, junk):
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefghijklmnopqrst", k=rng.choice([3, 4, 5, 6, 7]))) for _ in range(2_000)]

    def text(bad: bool) -> str:
        w = rng.choices(words, k=120)
        if bad and junk == "symbol":
            w = [x + "#$" * 2 for x in w]
        if bad and junk == "upper":
            w = [x.upper() for x in w]
        if bad and junk == "long":
            w = [x * 4 for x in w]
        if bad and junk == "short":
            w = [x[0] for x in w]
        lines = [" ".join(w[i:i + 6]) for i in range(0, 120, 6)]
        if bad and junk == "lines":  # half of the lines are copies, of few words
            lines = lines[:10] + [x for x in ["and so", "but no"] for _ in range(15)]
        return "\n".join(lines)

    rows = [(i, "en", "hot", text(i % 3 == 0)) for i in range(600)]
    stats = quality_rules.measure(spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")).cache()
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judge(stats, quality_rules.thresholds(stats)).collect()}
    assert not any(kept[i] for i in kept if i % 3 == 0)
    assert sum(kept[i] for i in kept if i % 3) >= 0.97 * 400


def generated(spark, groups):
    """Rows of measured ratios, drawn for each group (lang, source, n, level)."""
    rng = random.Random(5)
    rows = []
    for lang, source, n, level in groups:
        for _ in range(n):
            some = lambda top: rng.random() * top * level if rng.random() < 0.3 else 0.0
            rows.append((lang, source, 100, some(0.01), some(0.05), some(0.05), some(0.03), 5 + rng.gauss(0, 0.1) * level))
    names = ", ".join(f"{r} double" for r in quality_rules.RATIOS)
    return spark.createDataFrame(rows, f"lang string, source string, n_words long, {names}")


def test_each_ratio_follows_its_group(spark):
    limits = {r["source"]: r for r in quality_rules.thresholds(generated(spark, [("en", "calm", 3000, 1.0), ("en", "wild", 3000, 3.0)])).collect()}
    for ratio, bound in quality_rules.RATIOS.items():
        calm, wild = (limits[s][f"high_{ratio}"] for s in ("calm", "wild"))
        assert calm < wild and bound not in (calm, wild), ratio
    assert limits["calm"]["low_word_length"] > limits["wild"]["low_word_length"]


def test_one_more_row_moves_a_fence_little(spark):
    groups = [("en", "large", 3000, 1.0), ("fr", "other", 500, 1.0)]
    fences = []
    for n in (199, 200, 201):
        rows = quality_rules.thresholds(generated(spark, [*groups, ("en", "small", n, 3.0)])).collect()
        fences.append(next(r for r in rows if r["source"] == "small"))
    for name in [f"high_{r}" for r in quality_rules.RATIOS] + ["low_word_length"]:
        values = [f[name] for f in fences]
        assert max(values) - min(values) < 0.1 * abs(values[0]), name
    # between its own and its language's
    large = next(r for r in rows if r["source"] == "large")
    assert large["high_symbol_ratio"] < fences[0]["high_symbol_ratio"]

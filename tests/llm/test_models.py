"""The trained models against plain restatements, and on labels that they were not fitted to."""

import itertools
import re

import duckdb
import numpy as np

from conftest import SF_MID
from rewardlake.llm import lm, toxicity
from rewardlake.llm.common import least_hashes
from rewardlake.llm.queries import REGISTRY


#: Toxic documents are rare: the larger table has enough of them for a fit.
SF_LARGE = "/root/testdata/sf0.1"


def labelled(spark, name, label, sf_dir):
    truth = dict(duckdb.sql(f"select doc_id, {label} from '{sf_dir}/labels.parquet' where {label} is not null").fetchall())
    rows = {r["doc_id"]: r for r in REGISTRY[name](spark, sf_dir).collect()}
    return [(rows[i]["predicted"], y) for i, y in truth.items() if i in rows and rows[i]["held_out"]]


def test_quality_on_the_held_out_fold(spark):
    held = labelled(spark, "op4_quality_classifier", "quality", SF_MID)
    assert len(held) > 60 and sum(p == y for p, y in held) >= 0.95 * len(held)


def test_toxicity_on_the_held_out_fold(spark):
    held = labelled(spark, "op6_toxicity", "toxic", SF_LARGE)
    toxic = [p for p, y in held if y == 1]
    assert len(toxic) > 60 and sum(toxic) >= 0.8 * len(toxic)
    assert sum(p for p, y in held if y == 0) <= 0.01 * len(held)


def test_toxicity_scores_by_the_fitted_noisy_or():
    weights = {"idi*": 2.0, "idiom": 1.5, "fool": 4.0, "nic*": -3.0}
    model = toxicity.Model(weights, -3.0).prepare()
    sigmoid = lambda z: 1 / (1 + np.exp(-z))

    def plain(text):
        none, rest = 1.0, False
        for s in re.split(r"[.!?\n]", text):
            if not s.strip():
                continue
            words = re.findall(r"[^\W\d_]+", s.lower())
            told = {f for w in words for f in [w, *(w[:n] + "*" for n in range(3, 7) if n <= len(w))] if f in weights}
            if told:
                none *= 1 - sigmoid(-3.0 + sum(weights[f] for f in told))
            else:
                rest = True
        return 1 - none * (1 - sigmoid(-3.0) if rest else 1)

    for text in ("idiom idiot", "Idiot. fool! nice day", "nice", "nice. nicer? nicely", "plain words", "", " . \n", "idi. idi. idi",
                 "a fool and an idiom\n" * 30):
        assert abs(model.score(text)[0] - plain(text)) < 1e-12, text
    assert abs(model.score("idiom idiot")[0] - sigmoid(0.5)) < 1e-12  # the common beginning counts once


def test_forward_recursion_sums_over_all_paths():
    rng = np.random.default_rng(3)
    states, classes = 3, 5
    share = lambda *shape: (lambda x: x / x.sum(-1, keepdims=True))(rng.random(shape))
    model = lm.Model(share(states), share(states, states), share(states, classes).T)
    rows = [rng.integers(0, classes, n).astype("<u2") for n in (1, 2, 5, 7, 7, 3)]
    got = lm.log_likelihood(model, [r.tobytes() for r in rows])
    for row, value in zip(rows, got, strict=True):
        total = 0.0
        for path in itertools.product(range(states), repeat=len(row)):
            p = model.start[path[0]] * model.emit[row[0], path[0]]
            for t in range(1, len(row)):
                p *= model.move[path[t - 1], path[t]] * model.emit[row[t], path[t]]
            total += p
        assert abs(value - np.log10(total)) < 1e-9
    # expected counts: every token is in some state, every step one transition
    starts, moves, emits, fit = lm.expected_counts(model, iter([[r.tobytes() for r in rows]]))
    assert abs(starts.sum() - len(rows)) < 1e-3 and abs(moves.sum() - sum(len(r) - 1 for r in rows)) < 1e-3
    assert np.allclose(emits.sum(1), np.bincount(np.concatenate(rows), minlength=classes), atol=1e-3)
    assert abs(fit - got.sum()) < 1e-3


def test_expected_counts_are_those_of_all_paths():
    rng = np.random.default_rng(4)
    states, classes = 3, 5
    share = lambda *shape: (lambda x: x / x.sum(-1, keepdims=True))(rng.random(shape))
    model = lm.Model(share(states), share(states, states), share(states, classes).T)
    rows = [rng.integers(0, classes, n).astype("<u2") for n in (1, 6, 2, 6, 3, 1)]
    starts, moves, emits = np.zeros(states), np.zeros((states, states)), np.zeros((classes, states))
    for row in rows:
        chance = {}
        for path in itertools.product(range(states), repeat=len(row)):
            p = model.start[path[0]] * np.prod(model.emit[row, path])
            chance[path] = p * np.prod([model.move[a, b] for a, b in zip(path, path[1:])])
        whole = sum(chance.values())
        for path, p in chance.items():
            starts[path[0]] += p / whole
            for a, b in zip(path, path[1:]):
                moves[a, b] += p / whole
            for token, s in zip(row, path):
                emits[token, s] += p / whole
    for batches in ([rows], [rows[:1], rows[1:]], [[r] for r in rows]):
        got = lm.expected_counts(model, iter([[r.tobytes() for r in b] for b in batches]))
        for mine, plain in zip(got, (starts, moves, emits)):
            assert np.allclose(mine, plain, atol=1e-4)


def test_samples_by_a_bound_on_the_hash(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "doc_id")
    plain = [r["doc_id"] for r in rows.selectExpr("doc_id", "xxhash64(doc_id) as h").collect()]
    assert len(plain) == 20_000
    chosen = {r["doc_id"] for r in least_hashes(rows, 20_000, 500).collect()}
    assert len(chosen) == 500 and chosen == {r["doc_id"] for r in least_hashes(rows, 20_000, 500).collect()}
    assert {r["doc_id"] for r in least_hashes(rows.filter("doc_id < 300"), 300, 500).collect()} == set(range(300))

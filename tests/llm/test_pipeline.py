"""Each stage of the pipeline on its own input, against the operators' own rules."""

import re

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SF_SMALL
from rewardlake.llm import secrets
from rewardlake.session import materialize

from test_operators import docs, empty_dir, jaccard_classes, sf_dir  # noqa: F401


@pytest.fixture(scope="module")
def stages(spark, sf_dir):  # noqa: F811
    """Input and output rows of every stage."""
    df, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, f in corpus_pipeline.STAGES:
        after = materialize(spark, f(spark, df, sf_dir), "test-stage")
        out.append((name, df.collect(), after.collect(), df.columns, after.columns))
        df = after
    return out


def test_columns(stages):
    assert [s[0] for s in stages] == ["toxicity", "quality classifier", "n-gram Jaccard join", "secret scans", "packing"]
    assert all(before == after for _, _, _, before, after in stages[:-1])


def key(row):
    return str(row["doc_id"]), row["text"] or "", row["text"] is None


def test_filters_keep_rows_unchanged(stages):
    for _, before, after, _, _ in stages[:3]:
        assert set(map(key, after)) <= set(map(key, before)) and 0 < len(after) < len(before)


def test_toxic_go(stages):
    _, before, after, _, _ = stages[0]
    gone = set(map(key, before)) - set(map(key, after))
    words = re.compile("idiot|moron|scum|stupid|pathetic|worthless|disgusting|loser|trash|clown", re.I)
    small = [r for r in before if r["doc_id"] is not None and r["doc_id"] < 1_000]
    toxic = [r for r in small if len(words.findall(r["text"])) >= 3]
    clean = [r for r in small if not words.search(r["text"])]
    assert sum(key(r) in gone for r in toxic) >= 0.8 * len(toxic) > 0
    assert sum(key(r) in gone for r in clean) <= 0.05 * len(clean)


def test_one_of_each_group_stays(stages):
    _, before, after, _, _ = stages[2]
    classes, _ = jaccard_classes([(r["doc_id"], r["text"]) for r in before], 5, 4, 5)
    empty = sum(not n for _, n, _ in classes)
    filled = [r["doc_id"] for r in after if (r["text"] or "").strip(" \t\n\x0b\x0c\r")]
    # 6000 names two texts, each a class of its own
    assert sorted(i for i in filled if i not in (None, 6_000)) == sorted({c for _, n, c in classes if n and c not in (None, 6_000)})
    assert filled.count(6_000) == sum(i == 6_000 for i, _, _ in classes)
    assert len(after) - len(filled) == empty


def test_secrets_are_masked(stages):
    _, before, after, _, _ = stages[3]
    scanner = secrets.Scanner().prepare()
    assert len(before) == len(after)
    assert any(scanner.spans(r["text"] or "") for r in before)
    for r in after:
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))
    base = sum(len([s for s in scanner.spans(r["text"] or "") if s[1] < 3]) for r in after)
    assert base <= 0.05 * sum(len(scanner.spans(r["text"] or "")) for r in before)


def test_packed(stages):
    _, before, after, _, _ = stages[4]
    import public_tokenizers

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert sum(r["length"] for r in after) == sum(len(t.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in before)


def test_run_is_all_stages(spark, sf_dir, stages):  # noqa: F811
    assert corpus_pipeline.run(spark, sf_dir).count() == len(stages[-1][2])


def test_empty_tables(spark, empty_dir):  # noqa: F811
    assert corpus_pipeline.run(spark, empty_dir).count() == 0

"""A clean document is not toxic for its length."""

from conftest import SF_SMALL
from rewardlake.llm import toxicity
from rewardlake.llm.common import read_documents


def test_many_lines_without_telling_words(spark):
    docs = read_documents(spark, SF_SMALL)
    model = toxicity.train(spark, docs, read_documents(spark, SF_SMALL, "labels"))
    worst = max(model.weights, key=lambda f: (not f.endswith("*"), model.weights[f]))
    texts = ["7 ok\n" * 50_000, "7 ok\n" * 50_000 + f"you {worst} {worst}x", "7 ok\n", "\n" * 50_000]
    rows = toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    score = {r["doc_id"]: r["score"] for r in rows}
    assert score[0] == score[2] < toxicity.CUT and score[3] == 0 and score[1] > score[0]


def test_bias_counts_once():
    model = toxicity.Model({"idiot": 12.0}, -9.5).prepare()
    assert model.score("a line\n" * 50_000)[0] == model.score("a line")[0] < 0.001
    assert 0.5 < model.score("a line\n" * 50_000 + "idiot")[0] < 0.95

"""Personal data beyond the base spans: context, checksums, and very many matches in one text."""

import time

from pyspark.sql import functions as F

from rewardlake.llm import order_minhash, pii


def spans(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    rows = pii.find_spans(df).first()["pii"]
    return [(pii.KINDS[r["kind_no"]].name, text[r["start"]:r["end"]], r["score"]) for r in rows]


def test_context_words_move_the_score(spark):
    bare, = [s for s in spans(spark, "see 4111 1111 1111 1111 here") if s[0] == "card"]
    told, = [s for s in spans(spark, "my credit card 4111 1111 1111 1111 expires") if s[0] == "card"]
    unlike, = [s for s in spans(spark, "an example test number 4111 1111 1111 1111 only") if s[0] == "card"]
    assert bare[1] == told[1] and told[2] > bare[2] > unlike[2]


def test_checksums(spark):
    good, bad = "GB82 WEST 1234 5698 7654 32", "GB83 WEST 1234 5698 7654 32"
    assert [s[1] for s in spans(spark, f"iban {good} of the account") if s[0] == "iban"] == [good]
    assert not [s for s in spans(spark, f"iban {bad} of the account") if s[0] == "iban"]
    assert not [s for s in spans(spark, "card 4111 1111 1111 1112") if s[0] == "card"]


def test_very_many_matches_in_one_text(spark):
    words = [f"user{i}@mail{i % 7}.com" for i in range(20_000)]
    text = "é " + " ".join(words)
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    find = lambda: pii.find_spans(df).select(F.transform("pii", lambda s: F.struct(s["start"], s["end"])).alias("p")).first()["p"]
    find()  # compiled
    began = time.time()
    found = find()
    took = time.time() - began
    at, want = 2, []
    for w in words:
        want.append((at, at + len(w)))
        at += len(w) + 1
    assert [tuple(f) for f in found] == want
    assert took < 12


def test_units_beyond_the_last_place(spark, monkeypatch):
    """With places of 4 bits: a text of more units has a fingerprint, the same each time, and like texts have like ones."""
    monkeypatch.setattr(order_minhash, "_PLACE", 4)
    monkeypatch.setattr(order_minhash, "_MASK", 15)
    words = [f"w{i}" for i in range(200)]
    rows = [" ".join(words), " ".join(words), " ".join([*words[:100], "x", *words[101:]]), " ".join(f"v{i}" for i in range(200))]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, text string")
    a, b, c, d = (r["f"] for r in order_minhash.with_fingerprint(df, "text", "f").orderBy("i").collect())
    assert a == b and len(set(a) & set(c)) > len(a) / 2 and not set(a) & set(d)

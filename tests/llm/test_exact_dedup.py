"""Operator 13: fingerprints compose, collisions do no harm, awkward tables against SQL."""

import random

import duckdb
import pytest

from rewardlake.llm import exact_dedup as D
from rewardlake.llm.common import read_documents


def test_fingerprints_compose():
    rng = random.Random(6)
    for modulus in (D.MODULUS, 7, 10007):
        for _ in range(100):
            data = rng.randbytes(rng.randrange(400))
            cuts = sorted(rng.randrange(len(data) + 1) for _ in range(rng.randrange(5)))
            parts = [data[a:b] for a, b in zip([0, *cuts], [*cuts, len(data)], strict=True)]
            assert D.composed([(D.polynomial(p, modulus), len(p)) for p in parts], modulus) == D.polynomial(data, modulus)
            left, total = len(data), 0
            for p in parts:
                left -= len(p)
                total += D.shifted(D.polynomial(p, modulus), left, modulus)
            assert total % modulus == D.polynomial(data, modulus)


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("exact"))
    rng = random.Random(9)
    texts = ["", None, "Same Text", "same text", "SAME TEXT ", "É", "é", "日本", "x" * 70_000, "X" * 70_000, "x" * 69_999 + "y", "\x00", "\x00\x00"]
    texts += ["".join(rng.choices("ab", k=12)) for _ in range(200)]  # many of one length
    rows = [(i, rng.choice(texts)) for i in range(800)] + [(900, "a repeated row")] * 3 + [(None, "a repeated row"), (None, "no id"), (None, "NO id")]
    rows += [(901, "one id"), (901, "two texts")]
    extra = [(*r, 1, "f", "n", 5, True) for r in rows]
    spark.createDataFrame(extra, "doc_id long, text string, n int, fp string, name string, rid long, kept boolean") \
        .repartition(4).write.parquet(f"{d}/documents.parquet")
    return d


def expected(d):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{d}/documents.parquet/*.parquet')")
    cur = con.execute(D.OP13_SQL)
    names = [c[0] for c in cur.description]
    return sorted((tuple(sorted(zip(names, r, strict=True))) for r in cur.fetchall()), key=repr)


def test_odd_rows_equal_plain_sql(spark, odd_dir):
    got = sorted((tuple(sorted(r.asDict().items())) for r in D.op13_exact_dedup(spark, odd_dir).collect()), key=repr)
    assert got == expected(odd_dir)


def digest(df):
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], bytes(r["name"])) for r in df.collect()), key=repr)


def test_texts_that_share_a_fingerprint_are_told_apart(spark, odd_dir):
    docs = read_documents(spark, odd_dir)
    want = digest(D.exact_groups(spark, docs))
    assert digest(D.exact_groups(spark, docs, modulus=7)) == want
    named = D.fingerprints(spark, docs, modulus=7)
    assert named.select("n", "fp").distinct().count() < named.select("name").distinct().count()


def test_huge_documents_are_hashed_in_chunks(spark, odd_dir):
    docs = read_documents(spark, odd_dir)
    one = sorted(map(tuple, D.fingerprints(spark, docs).select("doc_id", "n", "fp", "name").collect()), key=repr)
    cut = sorted(map(tuple, D.fingerprints(spark, docs, huge=10, chunk=7).select("doc_id", "n", "fp", "name").collect()), key=repr)
    assert one == cut
    assert digest(D.exact_groups(spark, docs, huge=10, chunk=7)) == digest(D.exact_groups(spark, docs))


def test_empty_table(spark, odd_dir, tmp_path):
    spark.read.parquet(f"{odd_dir}/documents.parquet").filter("1 = 0").write.parquet(f"{tmp_path}/documents.parquet")
    assert D.op13_exact_dedup(spark, str(tmp_path)).collect() == []

"""Operator 12: potentials against the sum over orders, awkward tables against SQL."""

import random
from itertools import permutations

import duckdb
import pytest
from pyspark.sql import functions as F

from rewardlake.llm import filter_audit as A


def test_potentials_are_shapley_values_of_all_orders(spark):
    rng = random.Random(4)
    counts = [(part, mask, rng.randrange(50), 0, 0) for part in ("p", "q") for mask in range(32) if rng.random() < 0.6]
    df = spark.createDataFrame(counts, "part string, mask int, n long, good long, toxic long")
    got = {(r["part"], r["filter_order"], r["step"]): r for r in A.audit(df).collect()}
    assert len(got) == 2 * 120 * 5
    for part in ("p", "q"):
        removed = dict.fromkeys(A.LETTERS, 0)
        for order in permutations(A.LETTERS):
            gone = 0
            for step, letter in enumerate(order, 1):
                bit = 1 << A.LETTERS.index(letter)
                here = sum(n for p, m, n, *_ in counts if p == part and m & bit and not m & gone)
                row = got[part, "".join(order), step]
                gone |= bit
                assert row["removed"] == here
                assert row["kept"] == sum(n for p, m, n, *_ in counts if p == part and not m & gone)
                removed[letter] += here
        for (p, order, step), row in got.items():
            if p == part:
                assert row["shapley"] == removed[order[step - 1]]


def test_other_numbers_of_filters(spark):
    counts = [("p", 0, 5, 1, 0), ("p", 1, 2, 1, 0), ("p", 3, 4, 0, 1), ("p", 2, 1, 1, 1)]
    df = spark.createDataFrame(counts, "part string, mask int, n long, good long, toxic long")
    got = {(r["filter_order"], r["step"]): r for r in A.audit(df, "XY").collect()}
    assert {k: r["removed"] for k, r in got.items()} == {("XY", 1): 6, ("XY", 2): 1, ("YX", 1): 5, ("YX", 2): 2}
    assert got["XY", 1]["shapley"] == 8 and got["XY", 2]["shapley"] == 6
    assert got["XY", 2]["redundant"] == 4 and got["XY", 2]["unique_fails"] == 1 and got["YX", 1]["toxic_lost"] == 2


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("audit"))
    rng = random.Random(8)
    texts = [" ".join(rng.choices(["alpha", "Beta", "x", "$", "日本", "ß", "ÀB", "CAPS"], k=rng.choice([0, 3, 49, 50, 80])))
             for _ in range(60)] + ["", None, " \t\n\x0b", "word " * 30_000, "a\x1cb " * 60, "A" * 50_000]
    rows = [(i, rng.choice(texts), rng.choice(["s1", "s2", "", None])) for i in range(300)]
    rows += [(7, "one id, two texts", "s1"), (7, "one id, two texts", "s1"), (None, texts[0], "s1"), (None, None, None)]
    extra = [(*r, 3, True, "z", 1.0, "m") for r in rows]
    spark.createDataFrame(extra, "doc_id long, text string, source string, n long, good boolean, part string, toxic double, mask string") \
        .repartition(3).write.parquet(f"{d}/documents.parquet")
    marks = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 320, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    spark.createDataFrame(marks, "doc_id long, quality long, toxic long").write.parquet(f"{d}/labels.parquet")
    return d


def expected(d):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet/*.parquet')")
    cur = con.execute(A.OP12_SQL)
    names = [c[0] for c in cur.description]
    return sorted(tuple(sorted(zip(names, r, strict=True))) for r in cur.fetchall())


def test_odd_rows_equal_plain_sql(spark, odd_dir):
    got = sorted(tuple(sorted(r.asDict().items())) for r in A.op12_filter_audit(spark, odd_dir).collect())
    assert got == expected(odd_dir)
    assert {dict(r)["part"] for r in got} == {"", "s1", "s2"}


def test_masks_cover_every_row_once(spark, odd_dir):
    docs, labels = (spark.read.parquet(f"{odd_dir}/{t}.parquet") for t in ("documents", "labels"))
    assert A.mask_counts(docs, labels).agg(F.sum("n")).first()[0] == docs.count()


def test_empty_tables(spark, odd_dir, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{odd_dir}/{t}.parquet").filter("1 = 0").write.parquet(f"{tmp_path}/{t}.parquet")
    assert A.op12_filter_audit(spark, str(tmp_path)).collect() == []

"""Operator 11: block tables against plain dynamic programming, pieces of any size, awkward tables against SQL."""

import random

import duckdb
import pytest

from rewardlake.llm import turn_repair as T
from rewardlake.llm.common import read_documents


def plain(symbols):
    """(cost, edits) of the cheapest repair, by comparing whole edit strings."""
    def with_inserts(best):
        for _ in range(3):
            for q in range(4):
                cost, edits = best[T.DUE[q]]
                best[q] = min(best[q], (cost + T.INSERT, "I" + edits))
        return best
    best = with_inserts({0: (0, ""), 1: (10**6, ""), 2: (10**6, ""), 3: (0, "")})
    for s in reversed(symbols):
        now = {}
        for q in range(4):
            options = [(best[q][0] + T.DELETE, "D" + best[q][1])]
            if s:
                extra = T.TRUNCATED if s > 4 else 0
                due = best[T.DUE[q]]
                options.append((due[0] + T.REROLE + extra, "R" + due[1]))
                role = (s - 1) % 4 + 1
                kept = 1 if (role, q) == (1, 0) else T.DUE[q] if role == T.DUE[q] and role in (2, 3) else None
                if kept is not None:
                    options.append((best[kept][0] + extra, "K" + best[kept][1]))
            now[q] = min(options)
        best = with_inserts(now)
    return best[0]


def repaired_by(tables, symbols):
    edits, state = tables.edits(symbols, T.END, T.START)
    return tables.costs(symbols, T.END)[T.START], edits + "I" * T.closing(state)


@pytest.mark.parametrize("block", [1, 2, 3, 4])
def test_tables_give_the_least_cheapest_edits(block):
    tables, rng = T.Tables(block), random.Random(block)
    for size in range(25):
        for _ in range(60):
            symbols = bytes(rng.randrange(T.SYMBOLS) for _ in range(size))
            assert repaired_by(tables, symbols) == plain(symbols), symbols


def test_costs_compose_over_pieces():
    tables, rng = T.tables(), random.Random(5)
    for _ in range(200):
        a, b = (bytes(rng.randrange(T.SYMBOLS) for _ in range(rng.randrange(9))) for _ in range(2))
        after = tables.costs(b, T.END)
        assert tables.costs(a, after) == tables.costs(a + b, T.END)
        matrix = [tables.costs(a, T._inserted(list(u))) for u in T.UNITS]
        assert tuple(min(matrix[q][p] + after[q] for q in range(4)) for p in range(4)) == tables.costs(a + b, T.END)


def rows():
    rng = random.Random(3)
    roles = ["user", "assistant", "system", "tool", "", None, "User", "sage"]
    texts = ["Yes.", "No!", "why?", "cut off", "", " \t\n", None, "Yes. ", "日本。", "x.\x1c", "same text.", "a" * 3000 + "."]
    out = []
    for conv in range(60):
        for _ in range(rng.randrange(12)):
            out.append((conv if conv % 20 else None, rng.choice([None, *range(9)]), rng.choice(roles[:3] * 3 + roles), rng.choice(texts)))
    for turn in range(700):  # one long conversation, with texts that come again far later
        out.append((1000, turn, "user" if turn % 2 == 0 else "assistant", f"Turn {turn % 400}."))
    return out + [(2000, 0, "user", "Twice.")] * 3 + [(2001, None, None, None)]


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("talk"))
    extra = [(*r, 1, "x", True, 2, 3.0) for r in rows()]
    spark.createDataFrame(extra, "conv_id long, turn long, role string, text string, copies int, name string, done boolean, "
                          "part int, cost double").repartition(5).write.parquet(f"{d}/conversations.parquet")
    return d


def expected(d):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{d}/conversations.parquet/*.parquet')")
    cur = con.execute(T.OP11_SQL)
    names = [c[0] for c in cur.description]
    return sorted((tuple(sorted(zip(names, r, strict=True))) for r in cur.fetchall()), key=repr)


def got(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=repr)


def test_odd_rows_equal_plain_sql(spark, odd_dir):
    want = expected(odd_dir)
    assert got(T.op11_turn_repair(spark, odd_dir)) == want
    assert {dict(r)["conv_id"] for r in want} >= {None, 1000, 2000, 2001}


def test_pieces_of_any_size_give_the_same(spark, odd_dir):
    rows_ = T.damaged(read_documents(spark, odd_dir, "conversations"))
    whole = got(T.repaired(spark, rows_))
    assert got(T.repaired(spark, rows_, piece_rows=1)) == whole
    assert got(T.repaired(spark, rows_, piece_rows=7)) == whole


def test_conversations_over_many_partitions(spark, odd_dir):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(T.op11_turn_repair(spark, odd_dir)) == expected(odd_dir)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_empty_table(spark, odd_dir, tmp_path):
    spark.read.parquet(f"{odd_dir}/conversations.parquet").filter("1 = 0").write.parquet(f"{tmp_path}/conversations.parquet")
    assert T.op11_turn_repair(spark, str(tmp_path)).collect() == []

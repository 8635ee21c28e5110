"""Result-set equality properties (order/duplicates ignored, typed cells)."""

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rewardlake.operators import resultset as R

pytestmark = pytest.mark.usefixtures("spark")


def cells_df(spark, rows_by_side):
    """rows_by_side: {(episode, side): [tuple(python values)]} -> results table."""
    data = []
    for (ep, side), rows in rows_by_side.items():
        for i, row in enumerate(rows):
            cells = []
            for v in row:
                whole = isinstance(v, (bool, int)) or isinstance(v, float) and v == int(v)
                floor = math.floor(v) if isinstance(v, float) and not whole else None
                cells.append((int(v) if whole else None, v if isinstance(v, str) else None, None if floor is None else Decimal(floor),
                              None if floor is None else Decimal(repr(v)) % 1, None))
            data.append((ep, side, i, cells))
    return spark.createDataFrame(data, f"episode_id string, side string, row_no bigint, cells array<{R.CELL}>")


def equal(spark, pred, gold):
    res = cells_df(spark, {("e", "pred"): pred, ("e", "gold"): gold})
    eps = spark.createDataFrame([("e",)], "episode_id string")
    return R.result_set_rewards(eps, res).first()["sets_equal"]


def test_python_set_semantics(spark):
    assert equal(spark, [(1,), (1,)], [(1.0,)])
    assert not equal(spark, [("1",)], [(1,)])
    assert equal(spark, [], [])
    assert equal(spark, [(None, "a")], [(None, "a")])
    assert equal(spark, [(True,)], [(1,)])
    assert not equal(spark, [(1, 2)], [(1,)])
    assert not equal(spark, [(1,)], [])
    assert equal(spark, [(-0.0,)], [(0,)])


def test_permutation_duplication_and_symmetry(spark):
    rng = random.Random(7)
    base = [(rng.randint(0, 5), rng.choice("abc"), rng.random()) for _ in range(30)]
    shuffled = base[:] + base[:5]
    rng.shuffle(shuffled)
    assert equal(spark, base, shuffled) and equal(spark, shuffled, base)
    distinct = sorted(set(base))
    assert not equal(spark, distinct, distinct[1:])
    assert not equal(spark, distinct[1:], distinct)


def test_many_episodes_and_missing_episode(spark):
    res = cells_df(spark, {("a", "pred"): [(1,)], ("a", "gold"): [(1,)], ("b", "pred"): [(2,)], ("b", "gold"): [(3,)]})
    eps = spark.createDataFrame([("a",), ("b",), ("c",)], "episode_id string")
    got = {r["episode_id"]: r["sets_equal"] for r in R.result_set_rewards(eps, res).collect()}
    assert got == {"a": True, "b": False, "c": True}
    diff = {(r["episode_id"], r["only_in"]) for r in R.result_set_diff(res).collect()}
    assert diff == {("b", "pred"), ("b", "gold")}


def test_frames_match_live_frames(spark):
    p = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "a int, b string")
    g = spark.createDataFrame([(2.0, "y"), (1.0, "x")], "c double, d string")
    assert R.frames_match(p, g).first()["sets_equal"]
    g2 = spark.createDataFrame([("1", "x"), ("2", "y")], "c string, d string")
    assert not R.frames_match(p, g2).first()["sets_equal"]


def test_preview_text(spark):
    rows = [(i, "n") for i in range(23)]
    res = cells_df(spark, {("e", "pred"): rows})
    r = R.result_preview(res).first()
    lines = r["preview"].split("\n")
    assert lines[0] == "Result (23 rows):" and lines[1] == "  (0, 'n')" and lines[21] == "  ... (3 more rows)"
    assert r["n_rows"] == 23


def test_execution_observation(spark):
    res = cells_df(spark, {("e", "pred"): [(1,)]})
    prev = R.result_preview(res)
    ex = spark.createDataFrame([("e", "pred", "ok", None), ("e", "gold", "ok", None), ("f", "pred", "error", "no such table: t")],
                               "episode_id string, side string, status string, error string")
    got = {(r["episode_id"], r["side"]): r["observation"] for r in R.execution_observation(prev, ex).collect()}
    assert got[("e", "pred")] == "Result (1 rows):\n  (1,)\n"
    assert got[("e", "gold")] == R.NO_ROWS_TEXT
    assert got[("f", "pred")] == "Error: no such table: t"


def test_numbers_of_any_type_are_compared_exactly(spark):
    numbers = ["CAST(0.1 AS DOUBLE)", "CAST('0.1' AS DECIMAL(38,30))", "CAST('0.1' AS DECIMAL(3,1))", "CAST(0.1BD AS DECIMAL(38,38))",
               "CAST('0.100000000000000000000000000001' AS DECIMAL(38,30))", "CAST(1e25 AS DOUBLE)", "CAST('1e25' AS DECIMAL(38,0))",
               "CAST('10000000000000000000000001' AS DECIMAL(38,0))", "CAST('1e25' AS DECIMAL(38,5))", "CAST(-2.5 AS DOUBLE)",
               "CAST('-2.500' AS DECIMAL(38,30))", "CAST(7 AS TINYINT)", "CAST(7 AS DOUBLE)", "CAST('7.000' AS DECIMAL(20,3))",
               "CAST(9007199254740993 AS BIGINT)", "CAST(9007199254740992 AS DOUBLE)", "CAST(1e-30 AS DOUBLE)", "CAST('1e-30' AS DECIMAL(38,30))",
               "CAST(1.5e-300 AS DOUBLE)", "CAST(1e300 AS DOUBLE)", "CAST('NaN' AS DOUBLE)", "CAST('-Infinity' AS DOUBLE)", "CAST(-0.0 AS DOUBLE)",
               "CAST(0 AS BIGINT)", "CAST('-0.5' AS DECIMAL(38,38))", "CAST(-0.5 AS DOUBLE)", "'7'", "CAST(1 AS BIGINT)", "true",
               "CAST('9999999999999999999' AS DECIMAL(19,0))", "CAST('9999999999999999999.5' AS DECIMAL(20,1))"]
    keys = {}
    for n in numbers:
        row = R.frame_cells(spark.sql(f"SELECT {n} AS v")).first()["cells"][0]
        keys.setdefault(tuple(row), set()).add(n)
    groups = {frozenset(g) for g in keys.values()}
    same = [set(numbers[0:4]), {numbers[5], numbers[6], numbers[8]}, set(numbers[9:11]), set(numbers[11:14]), set(numbers[16:18]),
            set(numbers[22:24]), set(numbers[24:26]), set(numbers[27:29])]
    expected = {frozenset(g) for g in same} | {frozenset([n]) for n in numbers if not any(n in g for g in same)}
    assert groups == expected


def test_texts_of_exact_numbers(spark):
    t = lambda sql: R.frame_cells(spark.sql(f"SELECT {sql} AS v")).select(R.number_text(F.col("cells")[0])).first()[0]
    assert t("CAST('-2.500' AS DECIMAL(38,30))") == "-2.5"
    assert t("CAST('-0.05' AS DECIMAL(38,38))") == "-0.05"
    assert t("CAST('0.100000000000000000000000000001' AS DECIMAL(38,30))") == "0.100000000000000000000000000001"
    assert t("CAST(1e25 AS DOUBLE)") == "1" + "0" * 25
    assert t("'x'") is None
    s = lambda sql: spark.sql(f"SELECT {sql} AS v").select(R.shown(F.col("v"), T.DoubleType())).first()[0]
    assert [s(f"CAST({v} AS DOUBLE)") for v in ("1e25", "1.5e25", "1e-7", "0.0001", "1e16", "-3", "'NaN'")] == [
        "1e+25", "1.5e+25", "1e-07", "0.0001", "1e+16", "-3.0", "nan"]

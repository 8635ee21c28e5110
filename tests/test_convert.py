"""Converters: first-N with counters vs brute force, literal parsing, sinks."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from rewardlake.operators import convert
from rewardlake.plans import catalog as C
from rewardlake.sources import readers


def test_capped_stats_brute_force(spark):
    rows = [(i, "converted" if i % 3 else "skipped_short") for i in range(1, 40)]
    df = spark.createDataFrame(rows, "ordinal bigint, reason string")
    for n in (1, 5, 26, 100):
        got = {r["reason"]: r["n"] for r in convert.capped_stats(df, "ordinal", n).collect()}
        kept, counts = 0, {}
        for i, reason in rows:  # the reference loop
            if kept >= n:
                break
            counts[reason] = counts.get(reason, 0) + 1
            kept += reason == "converted"
        assert got == counts, n


@pytest.mark.parametrize("calls,ins,outs", [
    ([{"args": "1, 2", "expected": "3"}], ["1\n2"], ["3"]),
    ([{"args": "'a', [1, (2, 3)]", "expected": "(1, 'b')"}], ['"a"\n[1, [2, 3]]'], ['[1, "b"]']),
    ([{"args": "x", "expected": "1"}, {"args": "2 ** 3", "expected": "8"}, {"args": "-(7 // 2), [1 + 1]", "expected": "3 * 2.5"},
      {"args": "9 ** 9 ** 9", "expected": "1"}, {"args": "f(2)", "expected": "1"}, {"args": "1 / 0", "expected": "1"}],
     ["8", "-3\n[2]"], ["8", "7.5"]),
    ([{"args": "1, key=2", "expected": "{1, 2}"}], [], []),
    ([{"args": "None, True", "expected": "{'k': 1.5}"}], ["null\ntrue"], ['{"k": 1.5}'])])
def test_literal_parser(calls, ins, outs):
    assert convert.parse_literals(calls) == (ins, outs)


def test_rlvr_record_shape(spark):
    r = C.REGISTRY["q_rlvr_convert"](spark, SF_SMALL).first()
    gt = json.loads(r["ground_truth"])
    assert gt["fn_name"] == r["fn_name"] and len(gt["inputs"]) == len(gt["outputs"]) == r["n_tests"]


def test_sinks_round_trip(spark):
    back = dict(C.q_sink_jsonl(spark, SF_SMALL).groupBy("data_source").count().collect())
    assert back == {"cnn_dailymail": C.q_rlaif_convert(spark, SF_SMALL).count(), "mbpp": C.q_rlvr_convert(spark, SF_SMALL).count()}
    p = C.q_sink_prompt(spark, SF_SMALL)
    assert p.columns == ["prompt"] and p.count() == C.q_mtrl_convert(spark, SF_SMALL).count()


@pytest.mark.parametrize("n", [0, 1, 7, 29, 30, 31, 60, 61, 200])
def test_first_n_over_split_and_ordinal(spark, n):
    rows = [(split, i, "converted" if (i + split) % 3 else "skipped_short") for split in (0, 1) for i in range(45)]
    df = spark.createDataFrame(rows[::-1], "split_ord int, ordinal bigint, reason string").repartition(4)
    kept = [r for r in sorted(rows) if r[2] == "converted"][:n]
    order = ["split_ord", "ordinal"]
    assert sorted(map(tuple, convert.first_n(df.filter("reason = 'converted'"), order, n).collect())) == kept
    seen, counts = 0, {}
    for split, i, reason in sorted(rows):
        if seen >= n:
            break
        counts[reason] = counts.get(reason, 0) + 1
        seen += reason == "converted"
    assert dict(convert.capped_stats(df, order, n).collect()) == counts


def test_observe_and_empty_warning(spark):
    df = spark.createDataFrame([(1, "skipped_short")], "ordinal bigint, reason string")
    tagged, obs = readers.observe_counts(df, "t", "reason", ["converted", "skipped_short"])
    tagged.write.format("noop").mode("overwrite").save()
    assert obs.get["skipped_short"] == 1
    assert readers.warn_if_empty(obs) is not None


def test_schema_corpus_from_files(spark):
    files = C.q_schema_corpus(spark, SF_SMALL)
    direct = C.REGISTRY["q_regex_all"](spark, SF_SMALL).filter(F.col("ddl") != "")
    assert sorted(map(tuple, files.collect())) == sorted(map(tuple, direct.select("db_id", "ddl").collect()))


def test_sql_shapes_own_fixture(spark):
    dep = spark.createDataFrame([(i, f"D{i}", float(b)) for i, b in enumerate([5, 12, 40, 9, 11, 300, 2])],
                                "id int, name string, budget double")
    dep.createOrReplaceTempView("dep")
    assert spark.sql("SELECT count(*) AS n FROM dep WHERE budget > 10").first()["n"] == 4
    above = {r["name"] for r in spark.sql("SELECT name FROM dep WHERE budget > (SELECT avg(budget) FROM dep)").collect()}
    avg = sum([5, 12, 40, 9, 11, 300, 2]) / 7
    assert above == {f"D{i}" for i, b in enumerate([5, 12, 40, 9, 11, 300, 2]) if b > avg}

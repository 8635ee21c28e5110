"""Large JSON arrays read by byte ranges."""

import io
import json
import random

import pytest

from rewardlake.sources import arrays


def value(rng, deep=0):
    kind = rng.randrange(7 if deep < 3 else 4)
    if kind == 0:
        return rng.choice(["", 'a"b', "\\", 'x\\\\"y', ",],[{}", "é日", "\n", " \\u0041 "])
    if kind == 1:
        return rng.randrange(100)
    if kind == 2:
        return None
    if kind == 3:
        return rng.choice([True, 1.5, "plain text, with commas"])
    if kind == 4:
        return [value(rng, deep + 1) for _ in range(rng.randrange(3))]
    return {rng.choice('ab"c\\'): value(rng, deep + 1) for _ in range(rng.randrange(3))}


def by_ranges(text, size, ahead):
    state, depth, out = arrays.OUTSIDE, 0, []
    for start in range(0, len(text), size):
        data = text[start:start + size]
        f = io.BytesIO(text[start + size:])
        out += [(start + at, e) for at, e in arrays.elements(data, len(data), state, depth, start == 0, lambda: f.read(ahead))]
        ends = [arrays.passage(data, s) for s in range(3)]
        state, depth = ends[state][0], depth + ends[state][1]
    return out


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 13, 40, 10_000])
def test_every_element_once_at_any_range_size(size):
    rng = random.Random(size)
    for _ in range(300):
        want = [value(rng) for _ in range(rng.randrange(6))]
        text = json.dumps(want, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1])).encode()
        if rng.random() < 0.3:
            text = b" \n" * (rng.randrange(2)) + text + b"\n "
        found = by_ranges(text, size, rng.choice([1, 3, 7, 100]))
        assert [json.loads(e) for _, e in found] == want, text
        assert found == sorted(found) and len({at for at, _ in found}) == len(found)


def test_files_are_read_by_many_tasks_in_order(spark, tmp_path):
    rows = [{"id": str(i), "text": f'no {i}, "quoted" [and] {{so on}} \\ ' * (i % 7)} for i in range(3_000)]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    (tmp_path / "b.json").write_text(json.dumps(rows[0]))
    (tmp_path / "c.json").write_text("")
    (tmp_path / "d.json").write_text(" [ ] ")
    df = arrays.read_json_array(spark, str(tmp_path), "id string, text string", range_bytes=10_000)
    got = df.orderBy("file", "at").collect()
    assert [(r["id"], r["text"]) for r in got] == [(r["id"], r["text"]) for r in [*rows, rows[0]]]
    assert df.rdd.getNumPartitions() > 20


def test_states_told_together_as_one_by_one():
    rng = random.Random(5)
    for _ in range(3_000):
        data = bytes(rng.choice(b'"\\a,[]{}\n') for _ in range(rng.randrange(1, 12)))
        assert arrays.all_passages(data) == [x for state in range(3) for x in arrays.passage(data, state)], data


def test_many_ranges_share_tasks(spark, tmp_path):
    rows = [{"id": str(i), "text": "x, \"y\" " * 10} for i in range(2_000)]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    df = arrays.read_json_array(spark, str(tmp_path), "id string, text string", range_bytes=500)
    assert 20 < df.rdd.getNumPartitions() <= max(64, 4 * spark.sparkContext.defaultParallelism)
    assert [r["id"] for r in df.orderBy("file", "at").collect()] == [r["id"] for r in rows]

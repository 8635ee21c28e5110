"""Operator 3: secrets, by one deterministic automaton for all rules.

Every rule is a regular expression over bytes.  Their reversed forms are
joined into one nondeterministic automaton, made deterministic by subset
construction and minimised; one backward pass over a text's bytes then marks
where a match of each rule can begin.  From the leftmost mark that no earlier
match of the rule covers, the rule's own (equally built) forward automaton
gives the longest match.  The tables are small and travel with the task.

Defined results: a null or empty text has no spans; a null ``doc_id`` stays
null; repeated rows are each reported; an empty table gives no row; other
columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate
from operator import getitem, itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_and_text, read_documents


@dataclass(frozen=True)
class Rule:
    """``group`` of a match must have ``least`` bytes, else the match is dropped."""

    name: str
    pattern: bytes
    group: int = 0
    least: int = 1
    base: bool = False


RULES = (
    Rule("assign", rb"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6, True),
    Rule("access", rb"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", rb"[0-9a-f]{24,}", 0, 24, True),
    Rule("private_key", rb"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", rb"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", rb"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("jwt", rb"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
)


class Nfa:
    """States with byte edges and empty edges."""

    def __init__(self):
        self.edges: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def add(self, pattern: bytes, reverse: bool) -> tuple[int, int]:
        """The first and last state of a pattern, or of its mirror image."""
        return self._sequence(re._parser.parse(pattern), False, reverse)

    def _sequence(self, items: Iterable, fold: bool, reverse: bool) -> tuple[int, int]:
        first = last = self.state()
        for item in reversed(list(items)) if reverse else items:
            a, b = self._item(item, fold, reverse)
            self.empty[last].append(a)
            last = b
        return first, last

    def _item(self, item: tuple, fold: bool, reverse: bool) -> tuple[int, int]:
        kind, value = str(item[0]), item[1]
        if kind == "SUBPATTERN":
            return self._sequence(value[3], fold or bool(value[1] & re.IGNORECASE), reverse)
        first, last = self.state(), self.state()
        if kind == "BRANCH":
            for branch in value[1]:
                a, b = self._sequence(branch, fold, reverse)
                self.empty[first].append(a)
                self.empty[b].append(last)
        elif kind == "MAX_REPEAT":
            least, most, body = value
            at = first
            for _ in range(least):
                a, b = self._sequence(body, fold, reverse)
                self.empty[at].append(a)
                at = b
            if most == re._parser.MAXREPEAT:
                a, b = self._sequence(body, fold, reverse)
                self.empty[at] += [a, last]
                self.empty[b] += [a, last]
            else:
                for _ in range(most - least):
                    a, b = self._sequence(body, fold, reverse)
                    self.empty[at] += [a, last]
                    at = b
                self.empty[at].append(last)
        else:
            self.edges[first].append((self._bytes(kind, value, fold), last))
        return first, last

    @staticmethod
    def _bytes(kind: str, value, fold: bool) -> frozenset[int]:
        if kind == "LITERAL":
            found = {value}
        elif kind == "IN":
            found = set()
            for what, x in value:
                found |= {x} if str(what) == "LITERAL" else set(range(x[0], x[1] + 1))
        else:
            raise ValueError(f"a rule uses {kind}")
        if fold:
            found |= {ord(chr(c).swapcase()) for c in found if chr(c).isalpha()}
        return frozenset(found)

    def closure(self, states: Iterable[int]) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in found:
                    found.add(s)
                    todo.append(s)
        return frozenset(found)


def determine(nfa: Nfa, starts: list[int], ends: list[int], anywhere: bool) -> tuple[list[list[int]], list[int]]:
    """Subset construction: byte transitions and, for each state, the bits of the rules accepted there.

    ``anywhere``: a match may begin at any byte.
    """
    first = nfa.closure(starts)
    number, todo, table, accepts = {first: 0}, deque([first]), [], []
    while todo:
        here = todo.popleft()
        accepts.append(sum(1 << r for r, end in enumerate(ends) if end in here))
        moves: dict[int, set[int]] = {}
        for state in here:
            for found, to in nfa.edges[state]:
                for byte in found:
                    moves.setdefault(byte, set()).add(to)
        rest, known, row = (first if anywhere else frozenset()), {}, []
        for byte in range(256):
            to = frozenset(moves.get(byte, ()))
            if to not in known:
                known[to] = nfa.closure(to) | rest
            to = known[to]
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            row.append(number[to])
        table.append(row)
    return table, accepts


def minimise(table: list[list[int]], accepts: list[int]) -> tuple[list[list[int]], list[int]]:
    """Joins states that no input tells apart; state 0 stays the first."""
    group = {a: i for i, a in enumerate(dict.fromkeys(accepts))}
    of, n = [group[a] for a in accepts], 0
    while n < len(set(of)):
        n = len(set(of))
        seen: dict[tuple, int] = {}
        of = [seen.setdefault((of[s], *map(of.__getitem__, row)), len(seen)) for s, row in enumerate(table)]
    small = {of[s]: ([of[x] for x in row], accepts[s]) for s, row in reversed(list(enumerate(table)))}
    return [small[g][0] for g in range(len(small))], [small[g][1] for g in range(len(small))]


class Scanner:
    """All rules over whole texts.  ``mark`` is the joined automaton, ``ahead`` one for each rule."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        joined = Nfa()
        pairs = [joined.add(rule.pattern, reverse=True) for rule in rules]
        self.mark = minimise(*determine(joined, [a for a, _ in pairs], [b for _, b in pairs], anywhere=True))
        self.ahead = []
        for rule in rules:
            nfa = Nfa()
            a, b = nfa.add(rule.pattern, reverse=False)
            self.ahead.append(minimise(*determine(nfa, [a], [b], anywhere=False)))

    def prepare(self) -> Scanner:
        """In a worker: transition rows that hold each other, with the number of the accepted set of rules at 256."""
        table, accepts = self.mark
        self.sets = [0, *sorted(set(accepts) - {0})]
        if len(self.sets) > 256:
            raise ValueError("the rules accept together in more than 255 ways")
        rows: list[list] = [[] for _ in table]
        for row, to, bits in zip(rows, table, accepts, strict=True):
            row += [rows[x] for x in to]
            row.append(self.sets.index(bits))
        self.first = rows[0]
        self.dead = [next((s for s, row in enumerate(t) if not a[s] and set(row) == {s}), -1) for t, a in self.ahead]
        self.checks = [re.compile(rule.pattern) for rule in self.rules]
        return self

    def _longest(self, rule: int, data: bytes, start: int) -> int:
        (table, accepts), dead = self.ahead[rule], self.dead[rule]
        state, end = 0, start
        for at in range(start, len(data)):
            state = table[state][data[at]]
            if state == dead:
                break
            if accepts[state]:
                end = at + 1
        return end

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, rule, end) in code points, by start, then rule."""
        data = text.encode()
        n, found, ends = len(data), [], [0] * len(self.rules)
        found_sets = bytes(map(itemgetter(256), accumulate(data[::-1], getitem, initial=self.first)))
        if not found_sets.strip(b"\0"):
            return found
        marks = np.flatnonzero(np.frombuffer(found_sets, np.uint8)).tolist()
        for back in reversed(marks):
            start = n - back
            for r, rule in enumerate(self.rules):
                if self.sets[found_sets[back]] >> r & 1 and start >= ends[r]:
                    end = ends[r] = self._longest(r, data, start)
                    match = self.checks[r].fullmatch(data, start, end)
                    if len(match[rule.group]) >= rule.least:
                        found.append((start, r, end))
        if not text.isascii():
            at = [0, 0]

            def points(byte: int) -> int:
                if byte < at[0]:
                    at[:] = 0, 0
                at[:] = byte, at[1] + len(data[at[0]:byte].decode())
                return at[1]
            found = [(points(a), r, points(b)) for a, r, b in found]
        return sorted(found)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, secrets): the spans of each row, as (start, rule_no, end)."""
    scanner = Scanner(rules)
    kind = pa.list_(pa.struct([(c, pa.int32()) for c in ("start", "rule_no", "end")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = scanner.prepare()
        for batch in batches:
            spans = [[dict(zip(("start", "rule_no", "end"), s, strict=True)) for s in ready.spans(t.as_py())]
                     for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["doc_id", "secrets"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, secrets array<struct<start:int,rule_no:int,end:int>>")


def mask_text(scanner: Scanner, text: str) -> str:
    """``text`` with every secret replaced by its rule's name; overlapping spans become one."""
    out, at = [], 0
    for start, r, end in scanner.spans(text):
        if start >= at:
            out += [text[at:start], f"[{scanner.rules[r].name}]"]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


def mask(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with masked ``text``; where there is ``n_chars``, it counts the new text."""
    scanner = Scanner(rules)

    @F.pandas_udf("string")
    def masked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ready = scanner.prepare()
        for texts in batches:
            yield texts.map(lambda t: None if t is None else mask_text(ready, t))

    out = docs.withColumn("text", masked("text"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def span_text(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    names = F.array(*(F.lit(r.name) for r in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["rule_no"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    n_base = sum(r.base for r in RULES)
    count_of = lambda i: F.size(F.filter("secrets", lambda s: s["rule_no"] == i)).cast("long")
    base = F.filter("secrets", lambda s: s["rule_no"] < n_base)
    return scan(read_documents(spark, sf_dir)).select(
        "doc_id", *(count_of(i).alias(f"n_{r.name}") for i, r in enumerate(RULES) if r.base),
        F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"),
        span_text(F.col("secrets")).alias("spans"),
        *(count_of(i).alias(f"n_{r.name}") for i, r in enumerate(RULES) if not r.base))

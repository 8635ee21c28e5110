"""Operator 11: cheapest repair of a conversation's order of roles, by Four-Russians block tables.

A conversation's rows become symbols: must go, or the initial of the role and
whether the text is cut off.  The cost of repairing the rest of a conversation
depends on the state so far (nothing, a system row, a user row, an assistant
row) only: a vector of four numbers, which a symbol turns into the vector
before it.  Without their minimum few vectors can ever occur, so a table holds
what every block of ``BLOCK`` symbols makes of each: vector and offset.

* Costs: a conversation's blocks are looked up from its end to its start.
* Edits: forward from the start, each block is expanded backward from the
  vector after it, and the first edit, in ASCII order, whose cost fits the
  vectors is taken.  That is the least of the cheapest edit strings, since a
  cheapest rest follows each choice.

Spark sorts the rows by conversation and turn over ranges that a conversation
of any size may span, and texts seen earlier are found by hash of their texts.
A task cuts what it sees of a conversation into pieces of bounded size.
Conversations that lie within a task are done there.  The pieces of others
(those at a task's borders, and long ones) give a matrix each, the costs from
state to state by the same tables; per conversation these make the vector after
each piece; then its pieces are traced and hashed in order, one at a time.  Only
this hash, SHA-256 of the whole text, binds a conversation to one task.

Defined results: nulls are one space; rows of one turn (null turns come first)
go by role and text; an empty role has no initial, so its row can't be kept; a
null ``conv_id`` is a conversation; of repeated rows all but the first are
duplicates; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import read_documents

BLANKS = " \t\n\x0b\x0c\r"

# ---- fixed values: costs of the edits, their letters and the damage ----
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
LEGAL = ("su", "ua", "au")
DAMAGE_OF = 20  # crc32("conv:turn") modulo this: 0 drop, 1 empty, 2 unpunctuated, 3 repeated, 4 role user
# -------------------------------------------------------------------------

#: States: nothing yet, system, user, assistant.  What a user or assistant row, as is due, leads to.
START, SYSTEM, USER, ASSISTANT = range(4)
DUE = (USER, USER, ASSISTANT, USER)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
#: Symbols: 0 must go; 1-4 role s, u, a, another; 5-8 the same, cut off.
SYMBOLS, MUST_GO = 9, 0
INITIALS = {"s": 1, "u": 2, "a": 3}
#: Symbols in a block; rows and characters in a piece.
BLOCK, PIECE_ROWS, PIECE_CHARS = 4, 4096, 4 << 20
FAR = 1 << 40

Vector = tuple[int, int, int, int]


def kept_state(state: int, symbol: int) -> int | None:
    """The state after a row of that symbol is kept, if it may be."""
    role = (symbol - 1) % 4 + 1 if symbol else 0
    if role == 1:
        return SYSTEM if state == START else None
    due = DUE[state]
    return due if (role, due) in ((2, USER), (3, ASSISTANT)) else None


def _inserted(costs: list[int]) -> Vector:
    """The least costs when rows may be inserted first."""
    for _ in range(2):
        costs = [min(c, INSERT + costs[DUE[q]]) for q, c in enumerate(costs)]
    return tuple(min(c, FAR) for c in costs)


END: Vector = _inserted([0, FAR, FAR, 0])
UNITS = tuple(tuple(0 if p == q else FAR for p in range(4)) for q in range(4))


def before(vector: Vector, symbol: int) -> Vector:
    """The costs before a row, from those after it."""
    extra, costs = TRUNCATED if symbol > 4 else 0, []
    for state in range(4):
        best = DELETE + vector[state]
        if symbol != MUST_GO:
            best = min(best, REROLE + extra + vector[DUE[state]])
            kept = kept_state(state, symbol)
            if kept is not None:
                best = min(best, KEEP + extra + vector[kept])
        costs.append(best)
    return _inserted(costs)


def normal(vector: Vector) -> tuple[Vector, int]:
    least = min(vector)
    return tuple(min(v - least, FAR) if v < FAR else FAR for v in vector), least


class Tables:
    """All vectors that can occur, numbered, and what a symbol and a block make of each."""

    def __init__(self, block: int = BLOCK) -> None:
        self.block, self.vectors, self.number = block, [], {}
        step, offset = [], []
        for seed in (END, *(_inserted(list(u)) for u in UNITS)):
            self._add(normal(seed)[0])
        for vector in self.vectors:  # grows while it is read
            made = [normal(before(vector, s)) for s in range(SYMBOLS)]
            step.append([self._add(v) for v, _ in made])
            offset.append([o for _, o in made])
        self.step, self.offset = np.array(step), np.array(offset)
        nexts, offsets = self.step, self.offset
        for _ in range(block - 1):  # one more symbol in front
            nexts, offsets = (
                np.stack([self.step[nexts, s] for s in range(SYMBOLS)], 1).reshape(len(self.vectors), -1),
                np.stack([offsets + self.offset[nexts, s] for s in range(SYMBOLS)], 1).reshape(len(self.vectors), -1))
        self.nexts, self.offsets = nexts.tolist(), offsets.tolist()
        self.step, self.offset = self.step.tolist(), self.offset.tolist()
        self.places = SYMBOLS ** np.arange(block - 1, -1, -1)

    def _add(self, vector: Vector) -> int:
        if vector not in self.number:
            self.number[vector] = len(self.vectors)
            self.vectors.append(vector)
        return self.number[vector]

    def boundaries(self, symbols: bytes, end: int) -> tuple[list[int], int]:
        """The vectors at the start, after the symbols that fill no block, and after each block; and the offset of the first."""
        odd = len(symbols) % self.block
        codes = np.array(bytearray(symbols[odd:]), np.uint8).reshape(-1, self.block).astype(np.int64) @ self.places
        at, total, out = end, 0, [end]
        for code in codes[::-1].tolist():
            total += self.offsets[at][code]
            at = self.nexts[at][code]
            out.append(at)
        for symbol in reversed(symbols[:odd]):
            total += self.offset[at][symbol]
            at = self.step[at][symbol]
        return [at, *reversed(out)], total

    def costs(self, symbols: bytes, vector: Vector) -> Vector:
        """The costs before the symbols, from those after them."""
        rest, least = normal(vector)
        (first, *_), total = self.boundaries(symbols, self.number[rest])
        return tuple(min(v + total + least, FAR) for v in self.vectors[first])

    def edits(self, symbols: bytes, vector: Vector, state: int) -> tuple[str, int]:
        """The least cheapest edits of the symbols from that state, without inserts after the last, and the state they lead to."""
        bounds, _ = self.boundaries(symbols, self.number[normal(vector)[0]])
        odd, out = len(symbols) % self.block, []
        cuts = [0, *range(odd, len(symbols) + 1, self.block)]
        for a, b, after in zip(cuts, cuts[1:], bounds[1:], strict=False):
            inner = [after]
            for symbol in reversed(symbols[a:b]):
                inner.append(self.step[inner[-1]][symbol])
            inner.reverse()
            for symbol, here, then in zip(symbols[a:b], inner, inner[1:], strict=False):
                state = self._row(symbol, self.vectors[here], self.vectors[then], self.offset[then][symbol], state, out)
        return "".join(out), state

    @staticmethod
    def _row(symbol: int, here: Vector, then: Vector, offset: int, state: int, out: list[str]) -> int:
        extra = TRUNCATED if symbol > 4 else 0
        while True:
            cost = here[state] + offset
            if DELETE + then[state] == cost:
                out.append("D")
                return state
            if INSERT + here[DUE[state]] == here[state]:
                out.append("I")
                state = DUE[state]
                continue
            kept = kept_state(state, symbol) if symbol != MUST_GO else None
            if kept is not None and KEEP + extra + then[kept] == cost:
                out.append("K")
                return kept
            out.append("R")
            return DUE[state]


@lru_cache(1)
def tables() -> Tables:
    return Tables()


def closing(state: int) -> int:
    """How many rows are inserted after the last."""
    return {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}[state]


def applied(audit: str, rows: list[tuple[str, str]], state: int) -> Iterator[tuple[str, str]]:
    """The rows that edits give, from that state."""
    row = iter(rows)
    for edit in audit:
        if edit == "I":
            state = DUE[state]
            yield ROLE_OF[state], ""
            continue
        role, text = next(row)
        if edit == "K":
            state = SYSTEM if role[:1] == "s" else DUE[state]
            yield role, text
        elif edit == "R":
            state = DUE[state]
            yield ROLE_OF[state], text


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) with the damage; a dropped row stays, with no copy, to name its conversation."""
    c, space = conversations, F.lit(" ")
    key = F.concat(F.coalesce(c["conv_id"].cast("string"), space), F.lit(":"), F.coalesce(c["turn"].cast("string"), space))
    rows = c.select(c["conv_id"].cast("long").alias("conv_id"), c["turn"].cast("long").alias("turn"),
                    F.coalesce(c["role"], space).alias("role"), F.coalesce(c["text"], space).alias("text"),
                    (F.crc32(key.cast("binary")) % DAMAGE_OF).alias("_kind"))
    kind = F.col("_kind")
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(kind.isin(0, 1), F.lit("")).when(kind == 2, F.regexp_replace("text", "[.!?]+", "")).otherwise(F.col("text")).alias("text"),
        F.when(kind == 0, F.lit(0)).when(kind == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"))


def _turn(turn: Column) -> Column:
    return F.struct(turn.isNotNull().alias("some"), turn.alias("turn"))


def marked(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text, copies) with ``later``: role and text are in a lower turn of the conversation."""
    name = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    rows = rows.withColumn("name", name)
    some = rows.filter((F.col("copies") > 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    first = some.groupBy("conv_id", "name").agg(F.count("*").alias("n"), F.min(_turn(F.col("turn"))).alias("first")).filter("n > 1")
    first = materialize(spark, first.select(F.col("conv_id").alias("_conv"), F.col("name").alias("_name"), "first"), "repair-seen")
    rows = rows.join(first, rows["conv_id"].eqNullSafe(first["_conv"]) & (rows["name"] == first["_name"]), "left")
    later = F.coalesce(~F.col("first").eqNullSafe(_turn(F.col("turn"))) & F.col("first").isNotNull(), F.lit(False))
    return rows.select("conv_id", "turn", "role", "text", "copies", later.alias("later"))


_COUNTS = ["rows", "turns", "blank", "duplicate", "truncated", "illegal"]
_PIECE = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int64()), ("done", pa.bool_()),
                    ("low", pa.int64()), ("high", pa.int64()), *((c, pa.int64()) for c in _COUNTS),
                    ("head", pa.string()), ("tail", pa.string()), ("symbols", pa.binary()),
                    ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
                    ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
_PIECE_DDL = ("conv_id long, part int, seq long, done boolean, low long, high long, rows long, turns long, blank long, "
              "duplicate long, truncated long, illegal long, head string, tail string, symbols binary, "
              "roles array<string>, texts array<string>, cost long, audit string, repaired_sha256 string")


class _Piece:
    """What a task has seen of a conversation since it began or last cut it."""

    def __init__(self, conv: int | None) -> None:
        self.conv, self.low, self.high, self.symbols, self.kept, self.chars = conv, None, None, bytearray(), [], 0
        self.count = dict.fromkeys(_COUNTS, 0)

    def add(self, turn: int | None, role: str, text: str, duplicate: bool) -> None:
        count = self.count
        if turn is not None and turn != self.high:
            count["turns"] += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        if self.kept and self.kept[-1][0][:1] + role[:1] not in LEGAL:
            count["illegal"] += 1
        told = text.rstrip(BLANKS)
        symbol = INITIALS.get(role[:1], 4)
        if not told:
            count["blank"] += 1
            symbol = MUST_GO
        elif duplicate:
            count["duplicate"] += 1
            symbol = MUST_GO
        elif told[-1] not in ".!?":
            count["truncated"] += 1
            symbol += 4
        count["rows"] += 1
        self.symbols.append(symbol)
        self.kept.append((role, text))
        self.chars += len(role) + len(text) + 16

    def row(self, part: int, seq: int, whole: bool) -> dict:
        out = {"conv_id": self.conv, "part": part, "seq": seq, "done": whole, "low": self.low, "high": self.high, **self.count}
        if not whole:
            return out | {"head": self.kept[0][0][:1] if self.kept else None, "tail": self.kept[-1][0][:1] if self.kept else None,
                          "symbols": bytes(self.symbols), "roles": [r for r, _ in self.kept], "texts": [t for _, t in self.kept]}
        symbols = bytes(self.symbols)
        audit, state = tables().edits(symbols, END, START)
        audit += "I" * closing(state)
        told = "\n".join(f"{r}:{t}" for r, t in applied(audit, self.kept, START))
        return out | {"cost": tables().costs(symbols, END)[START], "audit": audit,
                      "repaired_sha256": hashlib.sha256(told.encode()).hexdigest()}


def _pieces(rows: DataFrame, piece_rows: int) -> DataFrame:
    """Pieces of conversations, in order of (part, seq); ``done`` where one is a whole conversation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, piece, before_, whole = TaskContext.get().partitionId(), 0, None, None, False
        for batch in batches:
            out = []
            for conv, turn, role, text, copies, later in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if piece is None:
                    piece = _Piece(conv)  # the task's first may have begun before it
                elif conv != piece.conv:
                    out.append(piece.row(part, seq, whole))
                    seq, piece, whole, before_ = seq + 1, _Piece(conv), True, None
                elif len(piece.kept) >= piece_rows or piece.chars > PIECE_CHARS:
                    out.append(piece.row(part, seq, False))
                    seq, piece, whole = seq + 1, _Piece(conv), False
                for _ in range(copies):
                    piece.add(turn, role, text, later or (turn, role, text) == before_)
                    before_ = (turn, role, text)
            if out:
                yield pa.RecordBatch.from_pylist(out, _PIECE)
        if piece is not None:  # the task's last may go on after it
            yield pa.RecordBatch.from_pylist([piece.row(part, seq, False)], _PIECE)

    order = ["conv_id", "turn", "role"]
    ranged = rows.repartitionByRange(*order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
    return ranged.select("conv_id", "turn", "role", "text", "copies", "later").mapInArrow(run, _PIECE_DDL)


def _ends(pieces: DataFrame) -> DataFrame:
    """(part, seq, ends, low, high, cost and counts of the conversation): the costs after each piece, from the matrices of those behind it."""
    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = [[c for unit in UNITS for c in tables().costs(s.as_py(), _inserted(list(unit)))] for s in batch.column("symbols")]
            yield pa.RecordBatch.from_arrays([*batch.drop_columns(["symbols"]).columns, pa.array(flat, pa.list_(pa.int64()))],
                                             names=[*batch.schema.names[:-1], "matrix"])

    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: (r["part"], r["seq"]))
        total, ends = {c: sum(r[c] for r in rows) for c in _COUNTS}, []
        low = high = tail = None
        for r in rows:
            if r["low"] is not None:
                total["turns"] -= r["low"] == high
                low, high = r["low"] if low is None else low, r["high"]
            if r["rows"]:
                total["illegal"] += tail is not None and tail + r["head"] not in LEGAL
                tail = r["tail"]
        vector = END
        for r in reversed(rows):
            ends.append(vector)
            # columns of the matrix: from every state to state q
            vector = tuple(min(min(r["matrix"][4 * q + p] + vector[q] for q in range(4)), FAR) for p in range(4))
        return pa.Table.from_pylist([
            {"part": r["part"], "seq": r["seq"], "ends": list(e), "cost": vector[START], "low": low, "high": high, **total}
            for r, e in zip(rows, reversed(ends), strict=True)], schema)

    schema = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("ends", pa.list_(pa.int64())), ("cost", pa.int64()),
                        ("low", pa.int64()), ("high", pa.int64()), *((c, pa.int64()) for c in _COUNTS)])
    ddl = "part int, seq long, ends array<long>, cost long, low long, high long, " + ", ".join(f"{c} long" for c in _COUNTS)
    narrow = pieces.select("conv_id", "part", "seq", "low", "high", *_COUNTS, "head", "tail", "symbols")
    names = ("conv_id long, part int, seq long, low long, high long, " + ", ".join(f"{c} long" for c in _COUNTS)
             + ", head string, tail string, matrix array<long>")
    return narrow.mapInArrow(matrices, names).groupBy("conv_id").applyInArrow(run, ddl)


def _traced(pieces: DataFrame, ends: DataFrame) -> DataFrame:
    """One row for each conversation in ``pieces``, traced piece by piece in order."""
    columns = ["conv_id", "low", "high", *_COUNTS, "cost"]
    schema = pa.schema([*((c, pa.int64()) for c in columns), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = None

        def close(of: dict) -> Iterator[pa.RecordBatch]:
            last = "I" * closing(of["state"])
            hash_rows(of, applied(last, [], of["state"]))
            yield pa.RecordBatch.from_pylist([{c: of["row"][c] for c in columns} | {
                "audit": "".join(of["audit"]) + last, "repaired_sha256": of["hash"].hexdigest()}], schema)

        def hash_rows(of: dict, rows: Iterator[tuple[str, str]]) -> None:
            for role, text in rows:
                of["hash"].update((("\n" if of["some"] else "") + f"{role}:{text}").encode())
                of["some"] = True

        for batch in batches:
            for row in batch.to_pylist():
                if open_ is None or row["conv_id"] != open_["row"]["conv_id"]:
                    if open_ is not None:
                        yield from close(open_)
                    open_ = {"row": row, "state": START, "audit": [], "hash": hashlib.sha256(), "some": False}
                audit, state = tables().edits(row["symbols"], tuple(row["ends"]), open_["state"])
                hash_rows(open_, applied(audit, list(zip(row["roles"], row["texts"], strict=True)), open_["state"]))
                open_["audit"].append(audit)
                open_["state"] = state
        if open_ is not None:
            yield from close(open_)

    rows = pieces.select("conv_id", "part", "seq", "symbols", "roles", "texts").join(ends, ["part", "seq"])
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    ddl = ", ".join(f"{c} long" for c in columns) + ", audit string, repaired_sha256 string"
    return rows.mapInArrow(run, ddl)


def repaired(spark: SparkSession, rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """One row for each conversation of ``rows`` (conv_id, turn, role, text, copies): its faults, the cost
    of its cheapest repair, the edits and the SHA-256 of what they give."""
    pieces = materialize(spark, _pieces(marked(spark, rows), piece_rows), "repair-pieces")
    out = ["conv_id", "low", "high", *_COUNTS, "cost", "audit", "repaired_sha256"]
    rest = pieces.filter("not done")
    full = pieces.filter("done").select(*out).unionByName(_traced(rest, _ends(rest)).select(*out))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0).cast("long"))
    return full.select("conv_id", gaps.alias("gaps"), *_COUNTS[2:], "cost", "audit", "repaired_sha256")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(spark, damaged(read_documents(spark, sf_dir, "conversations")))


def _oracle() -> str:
    """The same by plain dynamic programming in SQL, from the last row of each conversation to its first; the best of
    the edits by cost, then text.  Lists hold one entry a state: nothing yet, system, user, assistant."""
    due, due_role, due_initial = (3, 3, 4, 3), {3: "user", 4: "assistant"}, {3: "u", 4: "a"}

    def edit(letter: str, cost: str, then: str, item: str | None = None) -> str:
        rest = f"list_prepend({item}, {then}.r)" if item else f"{then}.r"
        return f"{{'c': {cost} + {then}.c, 'a': '{letter}' || {then}.a, 'r': {rest}}}"

    def best(options: list[str]) -> str:
        return f"list_sort([{', '.join(options)}])[1]"

    rows = []
    for q in range(4):
        to = due[q]
        options = [edit("D", "4", f"f[{q + 1}]"),
                   edit("R", "CASE WHEN gone THEN 1000000000 ELSE 3 + extra END", f"f[{to}]", f"'{due_role[to]}:' || text"),
                   edit("K", f"CASE WHEN gone OR ini <> '{due_initial[to]}' THEN 1000000000 ELSE extra END", f"f[{to}]", "role || ':' || text")]
        if q == START:
            options.append(edit("K", "CASE WHEN gone OR ini <> 's' THEN 1000000000 ELSE extra END", "f[2]", "role || ':' || text"))
        rows.append(best(options))
    inserts = []
    for q in range(4):
        one, two = due[q], due[due[q] - 1]
        once = edit("I", "3", f"g[{one}]", f"'{due_role[one]}:'")
        twice = (f"{{'c': 6 + g[{two}].c, 'a': 'II' || g[{two}].a, "
                 f"'r': list_concat(['{due_role[one]}:', '{due_role[two]}:'], g[{two}].r)}}")
        inserts.append(best([f"g[{q + 1}]", once, twice]))
    return f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT)),
           lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
             lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 20 AS kind
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]+', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM keyed WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos FROM damaged
), judged AS (
  SELECT *, left(role, 1) AS ini, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
         NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') AS cut,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair
  FROM placed
), faults AS (
  SELECT *, blank OR again AS gone, CASE WHEN cut AND NOT blank AND NOT again THEN 3 ELSE 0 END AS extra FROM judged
), convs AS (
  SELECT k.conv_id, count(f.pos) AS n, coalesce(max(f.turn) - min(f.turn) + 1 - count(DISTINCT f.turn), 0) AS gaps,
         count(*) FILTER (f.blank) AS blank, count(*) FILTER (f.again AND NOT f.blank) AS duplicate,
         count(*) FILTER (f.extra > 0) AS truncated, count(*) FILTER (f.pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT DISTINCT conv_id FROM conversations) k LEFT JOIN faults f ON k.conv_id IS NOT DISTINCT FROM f.conv_id
  GROUP BY k.conv_id
), costs AS (
  SELECT conv_id, n + 1 AS pos, [
    {{'c': 0, 'a': '', 'r': []::VARCHAR[]}}, {{'c': 6, 'a': 'II', 'r': ['user:', 'assistant:']}},
    {{'c': 3, 'a': 'I', 'r': ['assistant:']}}, {{'c': 0, 'a': '', 'r': []::VARCHAR[]}}] AS f
  FROM convs
  UNION ALL
  SELECT conv_id, pos, [{', '.join(inserts)}] FROM (
    SELECT costs.conv_id, faults.pos, [{', '.join(rows)}] AS g
    FROM costs JOIN faults ON costs.conv_id IS NOT DISTINCT FROM faults.conv_id AND faults.pos = costs.pos - 1)
)
SELECT convs.conv_id, gaps::BIGINT AS gaps, blank, duplicate, truncated, illegal, f[1].c::BIGINT AS cost, f[1].a AS audit,
       sha256(array_to_string(f[1].r, chr(10))) AS repaired_sha256
FROM convs JOIN costs ON convs.conv_id IS NOT DISTINCT FROM costs.conv_id AND costs.pos = 1
"""


OP11_SQL = _oracle()

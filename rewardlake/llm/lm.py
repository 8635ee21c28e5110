"""Operator 2: a hidden Markov language model of whole texts.

1. Word counts of the training rows: blocks send their distinct words to hash
   buckets, which add them up and answer each block with its words' counts.
2. Every text becomes a row of class ids.  The most frequent words are classes
   of their own; any other word belongs to a class by its ending, within which
   it has its add-one share.  The model's size is thus fixed by ``WORDS``,
   ``ENDINGS`` and ``STATES``, while every word keeps its own probability.
3. Baum-Welch: each pass runs scaled forward and backward recursions over all
   training rows in each partition, Spark adds the expected counts up, and the
   driver (it holds only the model) sets the new probabilities.
4. The scaled forward recursion gives each text's exact likelihood.

Defined results: a null or empty text is its end token; a null ``doc_id`` is
of the fold of the empty text; repeated rows are each scored and, in training,
each counted; without training rows every word is unknown and the model is
uniform; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .blocks import block_texts, block_words, bucket_count, expand, rows_of, squeeze, unpack_words
from .common import LOWER_AZ, fold, read_documents, with_blocks

FOLDS, HELD_OUT = 7, 2
#: Words with classes of their own, classes by ending, latent states, passes of training.
WORDS, ENDINGS, STATES, PASSES = 16_384, 1024, 8, 6
#: The end token; no word is empty.
END = b""
#: Words' worth of the corpus-wide distribution in each state's emissions, and of even transitions.
SMOOTH_EMIT, SMOOTH_MOVE = 5.0, 1.0
#: Tokens and texts that one recursion holds.
LANE_TOKENS, LANES = 400_000, 1024


def tokens(text: str) -> list[bytes]:
    """Words with A-Z lower-cased, without the end token."""
    return text.encode().translate(LOWER_AZ).split()


def ending(word: bytes) -> int:
    return zlib.crc32(word[-4:]) % ENDINGS


@dataclass
class Vocabulary:
    """What the counts tell: totals, the classes of frequent words, and the size of each class by ending."""

    total: int
    distinct: int
    own: dict[bytes, int]
    own_counts: np.ndarray
    ending_mass: np.ndarray  # of (c + 1) over the rare words of the class, and 1 for a word never seen

    def share(self) -> np.ndarray:
        """The classes' shares of all tokens, nearly."""
        mass = np.append(self.own_counts + 0.5, self.ending_mass)
        return mass / mass.sum()


def count_words(blocks: DataFrame, buckets: int) -> DataFrame:
    """Rows (block, words, counts) that answer the blocks, and per bucket one without a block:
    its most frequent words, their counts, its totals and its sums by ending."""
    def add(counter: Counter[bytes], row: dict) -> None:
        found = tokens(row["text"])
        found.append(END)
        counter.update(dict.fromkeys(found, 0) if row["held_out"] else found)

    most = 4 * WORDS // buckets + 64
    fields = [("block", pa.int64()), ("words", pa.binary()), ("counts", pa.binary()), ("total", pa.int64()),
              ("distinct", pa.int64()), ("by_ending", pa.list_(pa.int64()))]

    def run(group: pa.Table) -> pa.Table:
        known: dict[bytes, int] = {}
        parts = [(b, unpack_words(w), w, np.frombuffer(expand(c), "<u8").tolist())
                 for b, w, c in zip(*(group[x].to_pylist() for x in ("block", "words", "counts")), strict=True)]
        for _, words, _, counts in parts:
            for word, c in zip(words, counts, strict=True):
                known[word] = known.get(word, 0) + c
        rows = [{"block": b, "words": packed, "counts": squeeze(np.array([known[w] for w in words], "<u8").tobytes())}
                for b, words, packed, _ in parts]
        seen = {w: c for w, c in known.items() if c}
        by_ending = np.zeros(ENDINGS, np.int64)
        for word, c in seen.items():
            if word:
                by_ending[ending(word)] += c + 1
        top = sorted(seen, key=lambda w: (-seen[w], w))[:most]
        if top:
            rows.append({"block": None, "words": squeeze(b"\xff".join(top)),
                         "counts": squeeze(np.array([seen[w] for w in top], "<u8").tobytes()),
                         "total": sum(seen.values()), "distinct": len(seen), "by_ending": by_ending.tolist()})
        return pa.Table.from_pylist(rows, pa.schema(fields))

    return block_words(blocks.select("block", "text", "held_out"), add, buckets).groupBy("bucket").applyInArrow(
        run, "block long, words binary, counts binary, total long, distinct long, by_ending array<long>")


def vocabulary(counted: DataFrame) -> Vocabulary:
    """Reads the bucket summaries; what reaches the driver is bounded by ``WORDS`` and ``ENDINGS``."""
    summaries = counted.filter("block is null")
    totals = summaries.agg(F.sum("total"), F.sum("distinct")).first()
    mass = np.ones(ENDINGS)
    for e, n in summaries.select(F.posexplode("by_ending")).groupBy("pos").agg(F.sum("col")).collect():
        mass[e] += n
    top: list[tuple[int, bytes]] = []
    for row in summaries.select("words", "counts").toLocalIterator():
        counts = np.frombuffer(expand(bytes(row["counts"])), "<u8").tolist()
        top += zip((-c for c in counts), unpack_words(bytes(row["words"])), strict=True)
        top = sorted(top)[:WORDS] if len(top) > 8 * WORDS else top
    top = sorted(top)[:WORDS]
    own, counts = {END: 0}, [sum(-c for c, word in top if not word)]
    for c, word in top:
        if word:
            own[word] = len(own)
            counts.append(-c)
            mass[ending(word)] -= 1 - c
    return Vocabulary(int(totals[0] or 0), int(totals[1] or 0), own, np.array(counts, float), mass)


def as_classes(blocks: DataFrame, counted: DataFrame, vocab: Vocabulary) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, base_score, inner, ids) of every row; ``inner`` is the log10
    of the words' shares of their classes."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("base_score", pa.float64()), ("inner", pa.float64()), ("ids", pa.binary())])
    unit, log_mass, n_own = np.log10(vocab.total + vocab.distinct + 1), np.log10(vocab.ending_mass), len(vocab.own)

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        names: list[bytes] = []
        for words in answers["words"].to_pylist():
            names += unpack_words(words)
        seen = np.frombuffer(b"".join(map(expand, answers["counts"].to_pylist())), "<u8").astype(np.int64)
        index = dict(zip(names, range(len(names))))  # a word that comes twice has one count
        logs = np.log10(seen + 1.0)
        own = np.fromiter((vocab.own.get(w, -1) for w in names), np.int64, len(names))
        end = np.fromiter((zlib.crc32(w[-4:]) for w in names), np.int64, len(names)) % ENDINGS
        ids = np.where(own < 0, n_own + end, own).astype("<u2")
        inner = np.where(own < 0, logs - log_mass[end], 0.0)
        out: dict[str, list] = {c: [] for c in schema.names}
        for data in texts["docs"].to_pylist():
            rows = rows_of(data)
            out["doc_id"] += rows["doc_id"].to_pylist()
            out["held_out"] += rows["held_out"].to_pylist()
            for text in rows["text"]:
                words = tokens(text.as_py())
                words.append(END)
                at = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
                out["n_tokens"].append(len(words))
                out["n_known"].append(int(np.count_nonzero(seen[at])))
                out["base_score"].append(float(logs[at].sum() - unit * len(words)))
                out["inner"].append(float(inner[at].sum()))
                out["ids"].append(ids[at].tobytes())
        return pa.table(out, schema=schema)

    answers = counted.filter("block is not null").select("block", "words", "counts")
    return block_texts(blocks).groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, inner double, ids binary")


@dataclass
class Model:
    """``start[s]``, ``move[s, s']`` and ``emit[class, s]``."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @classmethod
    def fresh(cls, share: np.ndarray, states: int = STATES) -> Model:
        """Sticky transitions, and emissions spread at random (fixed seed) about the classes' shares."""
        noise = np.random.default_rng(7).gamma(1.0, size=(len(share), states)) + 0.2
        emit = share[:, None] * noise
        move = np.full((states, states), 0.1 / max(1, states - 1))
        np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
        return cls(np.full(states, 1 / states), move, emit / emit.sum(0))


def lanes(rows: list[bytes]) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Groups of rows of like length, longest first: their places, and the ids at each step of those still running."""
    sizes = np.array([len(r) // 2 for r in rows])
    order = np.argsort(-sizes, kind="stable")
    at = 0
    while at < len(order):
        longest = max(1, sizes[order[at]])
        group = order[at:at + max(1, min(LANES, LANE_TOKENS // longest))]
        at += len(group)
        length = sizes[group]
        ids = np.zeros((longest, len(group)), np.int32)
        for k, row in enumerate(group):
            ids[:length[k], k] = np.frombuffer(rows[row], "<u2")
        running = np.searchsorted(-length, -np.arange(longest), side="left")
        yield group, [ids[t, :n] for t, n in enumerate(running)]


def log_likelihood(model: Model, rows: list[bytes]) -> np.ndarray:
    """log10 of the probability of each row of ids, by the scaled forward recursion."""
    out, ones = np.zeros(len(rows)), np.ones(len(model.start))
    for group, steps in lanes(rows):
        total, alpha = np.zeros(len(group)), None
        for ids in steps:
            n = len(ids)
            seen = model.emit.take(ids, axis=0)
            seen *= model.start if alpha is None else alpha[:n] @ model.move
            scale = seen @ ones
            alpha = seen / scale[:, None]
            total[:n] += np.log10(scale)
        out[group] = total
    return out


def expected_counts(model: Model, batches: Iterator[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Baum-Welch sums over rows of ids: starts, transitions, emissions and the log10 likelihood.

    The tables of a group (emissions, alphas) have its steps one below the other and are worked on in place."""
    states, classes = len(model.start), len(model.emit)
    starts, moves, emits, fit = np.zeros(states), np.zeros((states, states)), np.zeros((classes, states)), 0.0
    start, move, emit = (x.astype(np.float32) for x in (model.start, model.move, model.emit))
    back, ones = np.ascontiguousarray(move.T), np.ones(states, np.float32)
    for rows in batches:
        for _, steps in lanes(rows):
            ids = np.concatenate(steps).astype(np.intp)
            edges = np.cumsum([0] + [len(s) for s in steps]).tolist()
            spans = list(zip(edges, edges[1:]))
            seen = emit.take(ids, axis=0)
            alphas, scales = np.empty_like(seen), np.empty((len(ids), 1), np.float32)
            before = None
            for lo, hi in spans:
                alpha, scale = alphas[lo:hi], scales[lo:hi]
                if before is None:
                    np.multiply(seen[lo:hi], start, out=alpha)
                else:
                    np.matmul(before[:hi - lo], move, out=alpha)
                    alpha *= seen[lo:hi]
                np.matmul(alpha, ones, out=scale[:, 0])
                alpha /= scale
                before = alpha
            fit += float(np.log10(scales, dtype=np.float64).sum())
            seen /= scales
            inner = np.zeros((states, states), np.float32)
            beta = None  # ones
            for (lo, hi), (onward_lo, onward_hi) in zip(spans[-2::-1], spans[:0:-1]):
                n, onward = onward_hi - onward_lo, seen[onward_lo:onward_hi]
                if beta is not None:
                    onward[:len(beta)] *= beta  # rows that end here have ones
                alpha = alphas[lo:lo + n]
                inner += alpha.T @ onward
                beta = onward @ back
                alpha *= beta  # from here on the state's share at this step
            moves += inner * move
            starts += alphas[:edges[1]].sum(0)
            for s in range(states):
                emits[:, s] += np.bincount(ids, weights=alphas[:, s], minlength=classes)
    return starts, moves, emits, fit


def train(coded: DataFrame, share: np.ndarray, passes: int = PASSES, states: int = STATES) -> tuple[Model, list[float]]:
    """Baum-Welch over ``coded.ids`` from the classes' shares; the model and each pass's log10 likelihood."""
    classes, n = len(share), states
    kind = pa.schema([("part", pa.int32()), ("at", pa.int32()), ("counts", pa.list_(pa.float64()))])

    def sums(model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            starts, moves, emits, fit = expected_counts(model, (b.column(0).to_pylist() for b in batches))
            used = np.flatnonzero(emits.any(1))
            yield pa.RecordBatch.from_pydict(
                {"part": [0] * len(used) + [1] * n + [2, 3], "at": used.tolist() + list(range(n)) + [0, 0],
                 "counts": [*emits[used].tolist(), *moves.tolist(), starts.tolist(), [fit] * n]}, kind)

        parts = coded.select("ids").mapInArrow(run, "part int, at int, counts array<double>")
        added = parts.groupBy("part", "at").agg(*(F.sum(F.get("counts", F.lit(s))).alias(f"s{s}") for s in range(n)))
        emits, moves, rest = np.zeros((classes, n)), np.zeros((n, n)), np.zeros((2, n))
        for part, at, *counts in added.collect():  # as many rows as classes and states
            (emits, moves, rest, rest)[part][at if part < 2 else part - 2] = counts
        return rest[0], moves, emits, float(rest[1, 0])

    model, fits = Model.fresh(share, states), []
    for _ in range(passes):
        starts, moves, emits, fit = sums(model)
        fits.append(fit)
        emits += SMOOTH_EMIT * share[:, None]
        model = Model((starts + 1) / (starts + 1).sum(), (moves + SMOOTH_MOVE) / (moves + SMOOTH_MOVE).sum(1, keepdims=True),
                      emits / emits.sum(0))
    return model, fits


def score(spark: SparkSession, docs: DataFrame) -> DataFrame:
    blocks = with_blocks(spark, docs)
    blocks = blocks.withColumn("held_out", fold(F.col("doc_id"), FOLDS) == HELD_OUT)
    counted = materialize(spark, count_words(blocks, bucket_count(spark)), "lm-words")
    vocab = vocabulary(counted)
    coded = materialize(spark, as_classes(blocks, counted, vocab), "lm-ids")
    model, _ = train(coded.filter(~F.col("held_out")), vocab.share())
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fit = log_likelihood(model, batch.column("ids").to_pylist())
            total = fit + batch.column("inner").to_numpy()
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(5)), pa.array(total)],
                                             names=[c.split()[0] for c in schema.split(", ")])

    return coded.select("doc_id", "held_out", "n_tokens", "n_known", "base_score", "inner", "ids") \
        .mapInArrow(run, schema).withColumn("train_tokens", F.lit(vocab.total).cast("long"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(spark, read_documents(spark, sf_dir)).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")

"""Structured Streaming forms of the scorers and monitors (STR1-STR4).

Every stream reads files with a fixed schema, runs with ``availableNow`` (all
data present, then stop) or any other trigger, and keeps its checkpoint in
the shared checkpoint folder so a restarted driver resumes where it stopped.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener

from ..functions.jsonfns import tool_calls_sql
from ..functions.text import extract_solution, extract_sql, observation_body
from ..operators.episodes import ERROR_PREFIX, MAX_TURNS
from ..operators.judge_reward import measured, scored
from ..operators.monitor import reward_monitor
from ..session import scratch_path


def run_available_now(df: DataFrame, sink: str, checkpoint: str, mode: str = "append", fmt: str = "parquet") -> None:
    """Run a stream over everything available, into a file sink."""
    q = (df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(sink))
    q.awaitTermination()


def stream_judge_scores(samples: DataFrame, replies: DataFrame, wait: str = "2 hours", delay: str = "1 hour") -> DataFrame:
    """STR1: samples (with event time ``ts``) scored when their judge's reply
    (``sample_id``, ``judge_text``, ``ts``) comes, in the same run or a later one.

    An outer join of the two streams: a sample waits in state, without its
    texts, until a reply whose time is within ``wait`` of its own comes, and gives
    one row, scored.  When both watermarks have passed its wait it gives one
    row without a score, ``pending``, and its state goes; so does a reply
    without a sample.  Of several replies to a sample the first to come counts.
    """
    s = measured(samples).withWatermark("ts", delay)
    r = replies.select("sample_id", "judge_text", F.col("ts").alias("reply_ts")).withWatermark("reply_ts", delay)
    r = r.dropDuplicatesWithinWatermark(["sample_id"])
    in_time = (F.col("reply_ts") >= F.col("ts")) & (F.col("reply_ts") <= F.col("ts") + F.expr(f"INTERVAL {wait}"))
    joined = s.join(r, (F.col("id") == F.col("sample_id")) & in_time, "left_outer")
    return scored(joined.withColumn("_replied", F.col("sample_id").isNotNull()))


def dedup_by_id(samples: DataFrame, ts_col: str, delay: str = "1 hour") -> DataFrame:
    """STR4: drop re-deliveries of the same ``id`` within the watermark."""
    return samples.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(["id"])


def windowed_monitor(events: DataFrame, ts_col: str, value_col: str, every: str = "1 day", delay: str = "1 hour",
                     slide: str | None = None, length_col: str | None = None) -> DataFrame:
    """STR3: mean reward (and mean episode length) per tumbling or sliding
    window.  In append mode a window is emitted once, when the watermark has
    passed it, its state goes, and rows that come later still are cut off."""
    return reward_monitor(events.withWatermark(ts_col, delay), ts_col, value_col, every, slide, length_col)


class BatchCounters(StreamingQueryListener):
    """SNK3 in streams: what ``counted`` observes, by micro-batch."""

    def __init__(self, name: str) -> None:
        self.name, self.by_batch, self._ended = name, {}, threading.Event()

    def onQueryStarted(self, event) -> None:  # noqa: N802 - names that Spark calls
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        seen = event.progress.observedMetrics.get(self.name)
        if seen is not None and event.progress.numInputRows:
            self.by_batch[event.progress.batchId] = {k: int(v or 0) for k, v in seen.asDict().items()}

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._ended.set()

    def totals(self, timeout: float = 60.0) -> dict[str, int]:
        """The sums over all batches, once the stream's last event has come."""
        if not self._ended.wait(timeout):
            raise TimeoutError(f"no end of the stream {self.name} within {timeout} s")
        out: dict[str, int] = {}
        for counts in self.by_batch.values():
            for key, n in counts.items():
                out[key] = out.get(key, 0) + n
        return out


def counted(df: DataFrame, name: str, reason_col: str, reasons: Sequence[str]) -> tuple[DataFrame, BatchCounters]:
    """A stream whose rows are counted per reason while they are written, and
    the listener, registered, that keeps the counts of each micro-batch; take it
    off again with ``spark.streams.removeListener``."""
    listener = BatchCounters(name)
    df.sparkSession.streams.addListener(listener)
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *(F.count_if(F.col(reason_col) == r).alias(r) for r in reasons)), listener


def run_complete_to_table(df: DataFrame, table_path: str, checkpoint: str) -> None:
    """Complete-mode aggregate kept as a table: every micro-batch overwrites it."""
    def write(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(table_path)
    q = (df.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
         .foreachBatch(write).trigger(availableNow=True).start())
    q.awaitTermination()


# ------------------------------------------------------------------ STR2
EPISODE_OUT = T.StructType([
    T.StructField("episode_id", T.StringType()), T.StructField("num_turns", T.IntegerType()),
    T.StructField("sql_attempts", T.IntegerType()), T.StructField("sql_errors", T.IntegerType()),
    T.StructField("empty_responses", T.IntegerType()), T.StructField("submitted_solution", T.BooleanType()),
    T.StructField("final_sql", T.StringType()), T.StructField("ended_by", T.StringType())])
# what has been counted; messages ahead of their turn are entries of their own
EPISODE_STATE = ("next_turn int, turns int, attempts int, errors int, empties int, waiting boolean, last_ms long, timer_ms long, "
                 "done boolean, ahead long")
AHEAD_KEY, AHEAD_VALUE = "turn int", "role string, solution string, has_sql boolean, is_error boolean, empty boolean"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def annotate_turns(traj: DataFrame) -> DataFrame:
    """Stateless per-message annotations (same expressions as batch)."""
    content = F.coalesce(F.col("content"), F.lit(""))
    sol = F.when(F.col("role") == "assistant", extract_solution(content))
    sql = F.when((F.col("role") == "assistant") & sol.isNull(),
                 F.coalesce(extract_sql(content), tool_calls_sql("tool_calls")))
    return traj.select("episode_id", "turn", "role", "ts", sol.alias("solution"), sql.alias("sql"),
                       F.when(F.col("role") == "user", observation_body(content)).alias("obs"),
                       ((F.col("role") == "assistant") & (content == "")).alias("empty"))


class _Episode:
    """An episode's counters, advanced message by message in turn order."""

    def __init__(self, state: tuple | None, first_turn: int, max_turns: int):
        (self.next_turn, self.turns, self.attempts, self.errors, self.empties, self.waiting, self.last_ms, self.timer_ms, self.done,
         self.ahead) = state or (first_turn, 0, 0, 0, 0, False, 0, 0, False, 0)
        self.max_turns = max_turns

    def state(self) -> tuple:
        return (self.next_turn, self.turns, self.attempts, self.errors, self.empties, self.waiting, self.last_ms, self.timer_ms,
                self.done, self.ahead)

    def outcome(self, solution: str | None, ended_by: str) -> tuple:
        return (self.turns, self.attempts, self.errors, self.empties, solution is not None, solution, ended_by)

    def take(self, turn: int, message: tuple) -> tuple | None:
        """Counts one message; the outcome if it decides the episode."""
        role, solution, has_sql, is_error, empty = message
        if turn != self.next_turn:
            self.waiting = False  # the observation was lost
        self.next_turn = turn + 1
        if self.waiting:  # the message after a statement is its observation
            self.waiting = False
            self.errors += int(role == "user" and is_error)
            if self.turns >= self.max_turns:
                return self.outcome(None, "turn_cap")
        if role == "assistant":
            self.turns += 1
            self.empties += int(empty)
            if solution is not None:
                return self.outcome(solution, "solution")
            self.attempts += int(has_sql)
            self.waiting = has_sql
            if self.turns >= self.max_turns and not has_sql:
                return self.outcome(None, "turn_cap")
        return None


class EpisodeProcessor(StatefulProcessor):
    """STR2's state: a value of counters, a map of the messages that came early, and a timer.

    A message in its turn touches the counters alone; an early one is written
    to the map once and removed once, however many wait beside it."""

    def __init__(self, timeout_ms: int, max_turns: int, first_turn: int) -> None:
        self.timeout_ms, self.max_turns, self.first_turn = timeout_ms, max_turns, first_turn

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counters = handle.getValueState("counters", EPISODE_STATE)
        self.early = handle.getMapState("early", AHEAD_KEY, AHEAD_VALUE)

    def _episode(self) -> _Episode:
        return _Episode(tuple(self.counters.get()) if self.counters.exists() else None, self.first_turn, self.max_turns)

    def _advance(self, episode: _Episode, new: dict[int, tuple]) -> tuple | None:
        """Counts what has come in turn order, up to the first gap."""
        while True:
            turn = episode.next_turn
            if turn in new:
                message = new.pop(turn)
            elif episode.ahead and self.early.containsKey((turn,)):
                message = tuple(self.early.getValue((turn,)))
                self.early.removeKey((turn,))
                episode.ahead -= 1
            else:
                return None
            if (out := episode.take(turn, message)) is not None:
                return out

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        (episode_id,) = key
        if episode_id is None:  # only moves the watermark
            return
        episode, new = self._episode(), {}
        for pdf in rows:
            episode.last_ms = max(episode.last_ms, int(pdf["ts"].max().timestamp() * 1000))
            if episode.done:
                continue
            for turn, role, solution, sql, obs, empty in zip(*(pdf[c] for c in ("turn", "role", "solution", "sql", "obs", "empty"))):
                if turn >= episode.next_turn:
                    new.setdefault(int(turn), (role, solution if isinstance(solution, str) else None, isinstance(sql, str),
                                               isinstance(obs, str) and obs.startswith(ERROR_PREFIX), bool(empty)))
        if episode.ahead:  # what came before counts, a re-delivery does not
            new = {t: m for t, m in new.items() if not self.early.containsKey((t,))}
        out = None if episode.done else self._advance(episode, new)
        if out is not None:
            episode.done, episode.ahead = True, 0
            self.early.clear()
        elif not episode.done:
            for turn, message in new.items():
                self.early.updateValue((turn,), message)
            episode.ahead += len(new)
        timer = max(episode.last_ms + self.timeout_ms, timerValues.getCurrentWatermarkInMs() + 1)
        if timer != episode.timer_ms:
            if episode.timer_ms:
                self.handle.deleteTimer(episode.timer_ms)
            self.handle.registerTimer(timer)
            episode.timer_ms = timer
        self.counters.update(episode.state())
        if out is not None:
            yield pd.DataFrame([(episode_id, *out)], columns=EPISODE_OUT.fieldNames())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        episode, out = self._episode(), None
        if not episode.done and episode.next_turn > self.first_turn:
            for turn, message in sorted(((k[0], tuple(v)) for k, v in self.early.iterator()), key=lambda m: m[0]):
                if (out := episode.take(turn, message)) is not None:
                    break
            out = out or episode.outcome(None, "timeout")
        self.counters.clear()
        self.early.clear()
        if out is not None:
            yield pd.DataFrame([(key[0], *out)], columns=EPISODE_OUT.fieldNames())

    def close(self) -> None:
        pass


def assemble_episodes(annotated: DataFrame, timeout: str = "30 minutes", max_turns: int = MAX_TURNS,
                      first_turn: int = 0) -> DataFrame:
    """STR2: one outcome row for each episode, as soon as it is decided.

    State holds counters and the messages that came before their turn, in the
    RocksDB state store, which this selects for streams started from now on.  An
    episode ends with its solution or the turn cap, or when the watermark
    passes its own last message by ``timeout``; then its state goes.  A decided
    episode's state stays until then too, so that re-delivered messages give
    no second row; messages without the first turn never give one.  A row
    without an episode id only moves the watermark.
    """
    annotated.sparkSession.conf.set(STATE_STORE, ROCKS_DB)
    return (annotated.withWatermark("ts", timeout).groupBy("episode_id")
            .transformWithStateInPandas(EpisodeProcessor(_ms(timeout), max_turns, first_turn), EPISODE_OUT, "Append", "EventTime"))


def _ms(interval: str) -> int:
    num, unit = interval.split()
    mult = {"second": 1000, "seconds": 1000, "minute": 60000, "minutes": 60000, "hour": 3600000, "hours": 3600000}
    return int(num) * mult[unit]


def stage_table(spark: SparkSession, df: DataFrame, name: str) -> str:
    """Write a derived table as the input folder of a file stream."""
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return path

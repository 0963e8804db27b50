"""Progress and state events as streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from framewright.workers import find_package


def _changes(idle_ms: int | None):
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        known = state.get[0] if state.exists else 0
        # A run's events of one micro-batch come in several frames, which are in order only together.
        rows = pd.concat(list(batches)).sort_values("seq", kind="stable")
        value = rows["percent"].fillna(0).astype("int64")
        if len(rows):
            yield rows[value != value.shift(1, fill_value=known)]
            known = int(value.iloc[-1])
        state.update((known,))
        if idle_ms is not None:
            state.setTimeoutDuration(idle_ms)

    return run


def progress_changes(events: DataFrame, idle_seconds: int | None = None) -> DataFrame:
    """A stream (run_id, seq, percent) to the events that change a run's percentage.

    The state is one number for each run; it goes when the run has been silent for ``idle_seconds``, if they are given (such a
    query looks for silent runs for ever, and does not end by itself when its input does). From one
    micro-batch to the next a run's events must arrive in the order of seq; those of one micro-batch are sorted.
    """
    find_package(events.sparkSession)
    idle_ms, timeout = (None, GroupStateTimeout.NoTimeout) if idle_seconds is None else (idle_seconds * 1000, GroupStateTimeout.ProcessingTimeTimeout)
    own = events.selectExpr("cast(run_id as string) run_id", "cast(seq as long) seq", "cast(percent as long) percent")
    return own.groupBy("run_id").applyInPandasWithState(_changes(idle_ms), "run_id string, seq long, percent long", "known long", "append", timeout)


def run_status(progress: DataFrame, states: DataFrame, silence: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Streams (run_id, ts, percent) and (run_id, ts) to a row for each run that has been silent for so long: how it ended.

    finished: some event had exactly 100. failed: there was a state event, whatever its code. terminal: either. elapsed_ms: from
    the first event to the last. State goes with the watermark, ``delay`` behind the latest event; append mode.
    """
    done = progress.select("run_id", "ts", F.coalesce(F.col("percent") == 100, F.lit(False)).alias("finished"), F.lit(False).alias("failed"))
    bad = states.select("run_id", "ts", F.lit(False).alias("finished"), F.lit(True).alias("failed"))
    both = done.union(bad).withWatermark("ts", delay)
    ended = both.groupBy("run_id", F.session_window("ts", silence)).agg(F.bool_or("finished").alias("finished"), F.bool_or("failed").alias("failed"), F.min("ts").alias("first"), F.max("ts").alias("last"))
    elapsed = F.floor((F.unix_micros(F.col("last").cast("timestamp")) - F.unix_micros(F.col("first").cast("timestamp"))) / 1000).cast("long")
    return ended.select("run_id", "finished", "failed", (F.col("finished") | F.col("failed")).alias("terminal"), elapsed.alias("elapsed_ms"))


def run_bounded(query: StreamingQuery, seconds: float = 1800) -> bool:
    """Waits for a query; stops it when the time is over. Whether it ended by itself."""
    ended = query.awaitTermination(seconds)
    if not ended:
        query.stop()
    return bool(ended)

"""Progress and state events of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Sequence numbers that are ordered together in one task.
SPAN = 100_000


def progress_changes(events: DataFrame, run: str = "run_id", seq: str = "seq", percent: str = "percent", span: int = SPAN) -> DataFrame:
    """Events whose percentage differs from the one before, which is 0 before the first; null counts as 0.

    A run may have any share of the events: each stretch of ``span`` sequence numbers
    is ordered by itself, and starts from the last event of the stretches before it.
    """
    seen = events.withColumn("_p", F.coalesce(percent, F.lit(0))).withColumn("_part", F.floor(F.col(seq) / span))
    last = seen.groupBy(run, "_part").agg(F.max_by("_p", seq).alias("_last"))
    before = last.withColumn("_before", F.lag("_last").over(Window.partitionBy(run).orderBy("_part"))).drop("_last")
    within = F.lag("_p").over(Window.partitionBy(run, "_part").orderBy(seq))
    joined = seen.withColumn("_prev", within).join(before.withColumnRenamed(run, "_run").withColumnRenamed("_part", "_own"), F.col(run).eqNullSafe(F.col("_run")) & (F.col("_part") == F.col("_own")))
    return joined.where(F.coalesce("_prev", "_before", F.lit(0)) != F.col("_p")).select(*events.columns)


def terminal_status(progress: DataFrame, states: DataFrame, run: str = "run_id", percent: str = "percent") -> DataFrame:
    """(run, finished, failed, terminal): finished at exactly 100; any state event, whatever its code, is a failure."""
    done = progress.select(run, F.coalesce(F.col(percent) == 100, F.lit(False)).alias("finished"), F.lit(False).alias("failed"))
    bad = states.select(run, F.lit(False).alias("finished"), F.lit(True).alias("failed"))
    out = done.union(bad).groupBy(run).agg(F.bool_or("finished").alias("finished"), F.bool_or("failed").alias("failed"))
    return out.withColumn("terminal", F.col("finished") | F.col("failed"))


def elapsed(events: DataFrame, run: str = "run_id", ts: str = "ts") -> DataFrame:
    """(run, elapsed_ms): from the first to the last event of each run."""
    ms = lambda c: F.unix_micros(c.cast("timestamp"))
    return events.groupBy(run).agg(F.floor((F.max(ms(F.col(ts))) - F.min(ms(F.col(ts)))) / 1000).cast("long").alias("elapsed_ms"))

"""Frame sequences: sampling, renumbering, cutting at the first failure, selection by number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.functions.text import frame_name, leading_int, sampling_step, split_tokens


def stride_sample(frames: DataFrame, step: Column | int, index: str = "frame_idx") -> DataFrame:
    """Every step-th frame from 0 on, with ``image_idx`` and ``image_name``, which have no gaps. No exchange."""
    step = F.lit(step).cast("long") if isinstance(step, int) else step
    number = F.floor(F.col(index) / step).cast("long")
    return frames.where(F.col(index) % step == 0).withColumn("image_idx", number).withColumn("image_name", frame_name(number))


def sample_at_rate(frames: DataFrame, rate: float, fps: str = "fps", index: str = "frame_idx") -> DataFrame:
    """Frames sampled at about ``rate`` a second of a video of ``fps``."""
    return stride_sample(frames, sampling_step(F.col(fps), rate), index)


def until_failure(frames: DataFrame, step: Column | int, capture: str = "capture_id", index: str = "frame_idx", grabbed: str = "grab_ok", read: str = "read_ok") -> DataFrame:
    """The frames of each capture before the first that fails: a kept one by ``read``, a skipped one by ``grabbed``; null is a failure.

    Failures are few: their minima by capture are taken before the exchange and
    joined back, so that no capture is gathered in a task. Where the minima are
    small Spark sends them to the frames instead.
    """
    step = F.lit(step).cast("long") if isinstance(step, int) else step
    ok = F.when(F.col(index) % step == 0, F.col(read)).otherwise(F.col(grabbed))
    ends = frames.where(~F.coalesce(ok, F.lit(False))).groupBy(F.col(capture).alias("_capture")).agg(F.min(index).alias("_end"))
    joined = frames.join(ends, frames[capture].eqNullSafe(ends["_capture"]), "left")
    return joined.where(F.col("_end").isNull() | (F.col(index) < F.col("_end"))).drop("_capture", "_end")


def export_listed(frames: DataFrame, listed: DataFrame, index: str = "frame_idx", text: str = "frame_list") -> DataFrame:
    """The frames whose numbers a list like ``20-50-30`` names; repeated numbers select once, negative ones nothing."""
    numbers = listed.select(F.explode(split_tokens(F.col(text), "-")).alias("token")).select(leading_int(F.col("token")).cast("long").alias(index))
    return frames.join(numbers.where(F.col(index) >= 0), index, "left_semi")


def capture_summary(captures: DataFrame, images: DataFrame, capture: str = "capture_id") -> DataFrame:
    """Images of each capture, and ``no frames`` as the reason where there are none."""
    counts = images.groupBy(capture).agg(F.count("*").alias("n_images"))
    n = F.coalesce("n_images", F.lit(0)).cast("long")
    return captures.select(capture).join(counts, capture, "left").select(capture, n.alias("n_images"), F.when(n == 0, F.lit("no frames")).alias("reason"))

"""Helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.workers import find_package

#: Words are maximal runs of anything but the six ASCII white-space characters.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a local one only where none is named."""
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="framewright-checkpoint-")
    context.setCheckpointDir(named)
    return context._jsc.sc().getCheckpointDir().get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Computes df once and keeps it in the shared folder, so that lost executors cost no recomputation."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small(df: DataFrame, rows: int, most: int = 500_000) -> DataFrame:
    """df, marked to be sent to all executors if its rows, counted, are few; else left to an exchange."""
    return F.broadcast(df) if rows <= most else df


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """df.mapInArrow, by workers that can import this package."""
    find_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def text_blocks(batches: Iterator[pa.RecordBatch], at: int, size: int) -> Iterator[pa.RecordBatch]:
    """The batches' rows again, with about ``size`` bytes of text in column ``at`` at a time; a longer text is a block of its own."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def long_array(values: list[int]) -> Column:
    """One literal, however many the values."""
    return F.lit(np.array(values, np.int64)) if len(values) else F.array().cast("array<bigint>")


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) that the parts alone decide: 52 bits of their MD5."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**52))

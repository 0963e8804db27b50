"""The corpus pipeline: five stages from raw documents to shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet in the shared folder and gives what it reads back to the next one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from framewright.llm import decontamination, langid, mixing, sharding, similar
from framewright.llm.common import checkpoint_dir, read_table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language that was learned from docs; those without letters go, and those in which no language has 0.35 of the probability."""
    return langid.keep_identified(docs, langid.train(docs))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies: SimHashes compared bit-sliced, Jaccard similarity of five-word shingles 0.8 or more."""
    return similar.near_dedup(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that hold no benchmark item's passages."""
    return decontamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Gives each source its words by weight: a document stays as often as the mix takes it, up to three times."""
    return mixing.mixed_documents(docs)


def hilbert_sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds shard and slot, in the order of a Hilbert curve through language, source and size."""
    return sharding.sharded(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("hilbert_sharding", hilbert_sharding),
]

#: A network, similar sets and tilings have no SQL; test_run_is_brute_force compares run() with plain versions of the stages.
ORACLE_SQL = None


def _remove(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sharded documents: the columns of documents, shard and slot.

    A stage's table goes when the next one's is complete; the last one's stays, for it is what the result reads.
    """
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = read_table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(path := f"{folder}/{k}-{name}")
        docs = spark.read.parquet(path)
        if before is not None:
            _remove(spark, before)
        before = path
    return docs

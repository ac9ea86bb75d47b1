"""Corpus pipeline over ``documents``; every stage is stored before the next one reads it.

Null texts, empty texts, repeated rows, null ids and extra columns are handled
as the operators of the stages define; an empty table stays empty throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm import decontaminate, mixing, ngram_join, quality, sharding
from rivulet.llm.common import load, stored

QUALITY = 0.3
# Rows that Spark hands to a Python task at a time. A document may be long, and the
# buffers of a batch, in the executor and in its workers, are never given back.
BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> None:
    """Texts in small Arrow batches, for all stages of the session."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, str(min(BATCH_ROWS, int(spark.conf.get(key)) or BATCH_ROWS)))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier (3): rows with a score below ``QUALITY`` go. Learned from
    the labelled rows of ``docs`` whose crc32(doc_id as text) mod 5 is not 0."""
    small_batches(spark)
    labels = load(spark, sf_dir, "labels")
    model = quality.train(docs, labels, quality.remainder(5) != 0)
    return (quality.score(docs, model).where(f"quality_score >= {QUALITY}")
            .drop("quality_score"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (1): of each component of documents whose 5-word shingles
    have a similarity of 0.8 or more, the one with the smallest doc_id stays."""
    small_batches(spark)
    return ngram_join.first_of_each(docs, 5, 80, 100)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination (8): documents in which an item is found go."""
    small_batches(spark)
    return decontaminate.clean(docs, load(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources (10): rows repeat as the mixture reads them, none is left out."""
    return mixing.mix_documents(docs, max_repeats=2.0)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sharding (2): shard and slot of every row, equal texts in one shard."""
    return sharding.op2_shards(docs, 40)


STAGES = [("quality", good_quality), ("near-duplicates", one_of_each),
          ("decontamination", without_benchmark), ("mixing", mix_sources), ("sharding", shard)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    out = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stored(stage(spark, out, sf_dir), f"pipeline-{name}")
    return out


# Trees, latent retrieval and the minimax search have no SQL form; the tests
# hold the pipeline against a brute-force version.
ORACLE_SQL = None

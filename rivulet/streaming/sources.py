"""Streaming sources: tables as file streams, landed text/JSON/XML feeds,
message-bus readers and landing of micro-batches."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Files per micro-batch of a table read as a stream.
MAX_FILES = 64


def table_stream(spark: SparkSession, sf_dir: str, name: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A driver table (``{sf_dir}/{name}.parquet``) as a Parquet file stream.

    The schema is taken from the batch table. The path is a glob for exactly
    this name, which matches the table as one file and as a folder of part
    files alike. A micro-batch reads at most ``max_files_per_trigger`` files
    (default ``MAX_FILES``), so its size is bounded whatever the table's.
    """
    schema = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet")).schema
    return parquet_stream(spark, os.path.join(sf_dir, f"{name}.parque[t]"), schema,
                          max_files_per_trigger or MAX_FILES)


def parquet_stream(spark: SparkSession, path: str, schema,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def text_stream(spark: SparkSession, path: str, column: str = "str",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed text files (one payload per line) as a stream of ``column``.

    A new query starts from the earliest file; a restarted query resumes
    after the last file recorded in its checkpoint, which replaces the
    consumer offsets the reference stored per consumer name.
    """
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path).withColumnRenamed("value", column)


def xml_entry_stream(spark: SparkSession, path: str, schema,
                     row_tag: str = "entry") -> DataFrame:
    """Landed XML feed files; every ``row_tag`` element becomes a row."""
    return (spark.readStream.format("xml").option("rowTag", row_tag)
            .schema(schema).load(path))


def bus_stream(spark: SparkSession, servers: str, topic: str,
               starting_offsets: str = "earliest") -> DataFrame:
    """Kafka topic as ``str`` payloads (needs the Kafka connector)."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
            .option("startingOffsets", starting_offsets).load()
            .select(F.col("value").cast("string").alias("str"),
                    F.col("topic"), F.col("partition"), F.col("offset")))


def landed_batches(df: DataFrame, batch_col: str, batches: list, path: str):
    """Land ``df`` batch by batch: yields the stream over everything landed so far.

    Each batch value is written to its own folder when the caller asks for it;
    a query run on the yielded stream with ``availableNow`` and one checkpoint
    then sees exactly the new folder as its next micro-batch, however many
    files or rows it has.
    """
    schema = df.drop(batch_col).schema
    for i, b in enumerate(batches):
        (df.where(F.col(batch_col) == F.lit(b)).drop(batch_col)
         .write.parquet(os.path.join(path, f"batch_{i:06d}")))
        yield parquet_stream(df.sparkSession, os.path.join(path, "batch_*"), schema)


def landed_stream(df: DataFrame, batch_col: str, batches: int, path: str,
                  files: int = 8) -> DataFrame:
    """``df`` landed in order of ``batch_col`` (0 .. batches - 1), then read as one
    stream: at most ``files`` files a batch, and as many per micro-batch, oldest first."""
    schema = df.drop(batch_col).schema
    for b in range(batches):
        (df.where(F.col(batch_col) == b).drop(batch_col).coalesce(files)
         .write.parquet(os.path.join(path, f"batch_{b:06d}")))
    return parquet_stream(df.sparkSession, os.path.join(path, "batch_*"), schema, files)

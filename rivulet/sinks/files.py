"""File, console and message-bus sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def file_sink(df: DataFrame, path: str, line: str = "line", mode: str = "append") -> None:
    """Write column ``line`` as newline-terminated text, one file per task
    (the reference's per-task ``.<index>`` suffix is the part-file number)."""
    df.select(F.col(line).cast("string").alias("value")).write.mode(mode).text(path)


def file_stream_sink(df: DataFrame, path: str, checkpoint: str, line: str = "line"):
    """Streaming form of :func:`file_sink` (exactly-once through the sink log)."""
    return (df.select(F.col(line).cast("string").alias("value")).writeStream
            .format("text").option("path", path).option("checkpointLocation", checkpoint))


def bus_sink(df: DataFrame, servers: str, topic: str, line: str = "line",
             checkpoint: str | None = None):
    """Writer for a Kafka topic: field ``line`` becomes the record value.

    Returns the configured ``DataStreamWriter`` (streaming input) or
    ``DataFrameWriter`` (batch input); calling ``start()``/``save()`` needs the
    Kafka connector on the classpath and a reachable broker.
    """
    out = df.select(F.col(line).cast("string").alias("value"))
    if df.isStreaming:
        w = (out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
             .option("topic", topic))
        return w.option("checkpointLocation", checkpoint) if checkpoint else w
    return (out.write.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic))


def feed_to_bus(documents: DataFrame, servers: str, topic: str, col: str = "str",
                checkpoint: str | None = None):
    """Writer that sends every entry's message of landed feed documents to a topic."""
    from rivulet.sources.documents import xml_feed_documents

    return bus_sink(xml_feed_documents(documents, col), servers, topic, "message", checkpoint)


def console_sink(df: DataFrame, num_rows: int = 20, truncate: bool = False):
    """Log sink for streams (``writeStream.format('console')``)."""
    return (df.writeStream.format("console").option("numRows", num_rows)
            .option("truncate", str(truncate).lower()))

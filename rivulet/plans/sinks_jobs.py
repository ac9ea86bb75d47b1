"""Line scans, file copies and the message-bus sink."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from rivulet.plans.registry import register
from rivulet.session import scratch_path, table
from rivulet.sinks import files as SK
from rivulet.sources import files as FS
from rivulet.streaming import operators as SO
from rivulet.streaming import sources as SS

_LINES_SQL = "SELECT unnest(string_split(text, chr(10))) AS line FROM documents"


def _land_documents(spark, sf_dir, path):
    """documents.text written as text files (a document per record)."""
    SK.file_sink(table(spark, sf_dir, "documents"), path, line="text")
    return path


@register("line_scan", _LINES_SQL)
def line_scan(spark, sf_dir):
    """Text files scanned as one row per line (column ``line``)."""
    path = _land_documents(spark, sf_dir, scratch_path(spark, "line_scan"))
    return FS.line_scan(spark, path)


@register("file_copy", _LINES_SQL)
def file_copy(spark, sf_dir):
    """Copy job, file -> files: line scan, then the file sink (one file per
    task, newline-terminated), read back."""
    root = scratch_path(spark, "file_copy")
    src = _land_documents(spark, sf_dir, os.path.join(root, "src"))
    dst = os.path.join(root, "dst")
    SK.file_sink(FS.line_scan(spark, src), dst, line="line")
    return FS.line_scan(spark, dst)


@register("stream_file_copy", _LINES_SQL)
def stream_file_copy(spark, sf_dir):
    """Streaming copy: a text file stream into the text file sink
    (exactly-once through the sink's commit log)."""
    root = scratch_path(spark, "stream_file_copy")
    src = _land_documents(spark, sf_dir, os.path.join(root, "src"))
    dst = os.path.join(root, "dst")
    lines = SS.text_stream(spark, src, "line")
    SO.run_available(SK.file_stream_sink(lines, dst, os.path.join(root, "_ckpt"), "line"))
    return FS.line_scan(spark, dst)


@register("bus_sink", "SELECT unnest(string_split(text, chr(10))) AS value FROM documents")
def bus_sink(spark, sf_dir):
    """File -> topic copy: the records a Kafka sink would receive (``value``
    = the line), with the writer configured for topic ``lines``. The
    connector and a broker are not available here, so the configured writer
    is built but not started."""
    path = _land_documents(spark, sf_dir, scratch_path(spark, "bus_sink"))
    lines = FS.line_scan(spark, path)
    SK.bus_sink(lines, "localhost:9092", "lines")  # configured, not started
    return lines.select(F.col("line").alias("value"))

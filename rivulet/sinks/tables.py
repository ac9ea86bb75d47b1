"""Keyed tables on shared storage: truncate-and-load, and feeds of changes.

A streaming job keeps its table in the state store and appends what each
micro-batch changed to a :class:`BatchLog`; the newest row per key is the table.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

def last_wins_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key: the one with the greatest ``order`` (map-side combined)."""
    values = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*[F.col(c) for c in values]), F.col(order))
    return df.groupBy(*keys).agg(best.alias("_v")).select(*keys, "_v.*")


def truncate_load(df: DataFrame, path: str, keys: list[str], value: str,
                  order: str | None = None) -> DataFrame:
    """Replace the table at ``path`` by ``(keys..., value)``; when a key repeats
    the row with the greatest ``order`` (the last one loaded) wins."""
    cols = keys + [value] + ([order] if order else [])
    rows = df.select(*cols)
    if order:
        rows = last_wins_per_key(rows, keys, order).drop(order)
    rows.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


class BatchLog:
    """Append-only per-batch output (change feeds, update feeds, histories).

    Batch ``b`` is written to its own partition ``batch_id=b`` with overwrite,
    so a replayed batch replaces its own output and nothing else; writing a
    batch costs the size of the batch, not of the history.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def write(self, rows: DataFrame, batch_id: int, by: str | None = None) -> None:
        writer = rows.drop("batch_id").write.mode("overwrite")
        if by:
            writer = writer.partitionBy(by)
        writer.parquet(os.path.join(self.path, f"batch_id={int(batch_id)}"))

    def read(self) -> DataFrame | None:
        """All batches with their ``batch_id``; None where nothing was written."""
        try:
            df = self.spark.read.parquet(self.path)
        except AnalysisException:
            return None
        return df.withColumn("batch_id", F.col("batch_id").cast("bigint"))

    def latest(self, keys: list[str]) -> DataFrame | None:
        """The table that the feed describes: the newest row per key."""
        log = self.read()
        return None if log is None else last_wins_per_key(log, keys, "batch_id").drop("batch_id")

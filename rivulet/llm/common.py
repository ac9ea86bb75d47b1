"""Table loading, shared-folder tables and connected components."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.session import scratch_path


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The whole table ``name`` (a file or a folder of part files)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage,
    survives lost executors, and lets several consumers scan one result."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


ROWS_A_TASK = 1 << 17  # short rows that are worth a task


def in_few_tasks(df: DataFrame, rows: int, a_task: int = ROWS_A_TASK) -> DataFrame:
    """``df``, a shuffle's result of about ``rows`` rows, in no more tasks (and files)
    than so many rows are worth; large tables keep the partitions they have."""
    return df.coalesce(4 + rows // a_task)


def discard(*tables: DataFrame) -> None:
    """Remove :func:`stored` tables that nothing reads any more. What was made of them
    must be stored itself: a lost executor must not need them again."""
    for table in tables:
        jvm = table.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(table._stored_at)
        path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(
            path, True)


def _stamp(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)),
                           F.sum(F.xxhash64("u", "v") % F.lit(1_000_000_007))).first())


def connected_components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """Components of the undirected graph ``links(a, b)`` (bigint node ids) of about
    ``rows`` rows, if that is known.

    Alternating large-star / small-star contraction: every round each node's
    larger neighbours are hung on its smallest neighbour, until nothing
    changes. The smallest neighbour is a partial aggregate and is stored
    before it is joined back, so that a hub's edges can be split by AQE; the
    edges never leave the executors. A round has no more tasks than its edges are
    worth. Returns ``(id, root)``, root the smallest id of the component; nodes
    without a link (or only a self link) are absent.
    """
    a, b = F.col("a"), F.col("b")
    edges = links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = stored(edges if rows is None else in_few_tasks(edges, rows), "cc-edges")
    stamp = _stamp(edges)
    while stamp[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        low = stored(in_few_tasks(low, stamp[0]), "cc-low")
        large = (both.join(low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = stored(in_few_tasks(large, stamp[0]), "cc-large")
        least = stored(in_few_tasks(large.groupBy("u").agg(F.min("v").alias("m")), stamp[0]), "cc-low")
        small = (large.join(least, "u").where(F.col("v") != F.col("m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        old, edges = edges, stored(in_few_tasks(small, stamp[0]), "cc-edges")
        discard(old, low, large, least)
        before, stamp = stamp, _stamp(edges)
        if stamp == before:
            break
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(
        in_few_tasks(roots, stamp[0]))

"""Keyed and global aggregations.

All of these are plain ``groupBy`` aggregations, so Spark plans them as a
partial (map-side) aggregate, one exchange on the grouping keys and a final
aggregate. A key holding a large share of the rows is therefore collapsed to
one partial row per map task before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions.text import split_words

# Fixed value: histogram bucket width used by the transactional words job.
BUCKET_SIZE = 10


def words(df: DataFrame, text: str = "text", mode: str = "java",
          keep: tuple = ()) -> DataFrame:
    """One row per word of ``text`` (columns ``keep`` + ``word``)."""
    return df.select(*keep, F.explode(split_words(text, mode)).alias("word"))


def word_count(df: DataFrame, text: str = "text", mode: str = "java",
               by: tuple = ()) -> DataFrame:
    """``(by..., word, count)``: occurrences of every word."""
    return (words(df, text, mode, keep=by)
            .groupBy(*by, "word").agg(F.count(F.lit(1)).alias("count")))


def global_count(df: DataFrame) -> DataFrame:
    """One row ``count``; Catalyst runs it as partial + final count."""
    return df.agg(F.count(F.lit(1)).alias("count"))


def max_by_key(df: DataFrame, keys, value: str, name: str = "max_value") -> DataFrame:
    """Maximum of ``value`` per key (the reference's combiner: zero = -inf).

    NaN is larger than any number in both Spark and the reference.
    """
    return df.groupBy(*keys).agg(F.max(value).alias(name))


def count_with_prev(df: DataFrame, key: str, batch: str = "batch_id") -> DataFrame:
    """Micro-batch keyed counts with the previous value.

    For each ``(key, batch)`` where the key occurs: the running count after
    that batch and the running count before it (NULL on first sight). This is
    the batch form of the transactional keyed-count updater.
    """
    per_batch = df.groupBy(key, batch).agg(F.count(F.lit(1)).alias("n"))
    w = (Window.partitionBy(key).orderBy(batch)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    running = per_batch.withColumn("count", F.sum("n").over(w))
    return running.select(
        key, batch, "count",
        F.lag("count").over(Window.partitionBy(key).orderBy(batch)).alias("prev_count"))


def bucket_of(c, size: int = BUCKET_SIZE):
    """Histogram bucket of a count: integer division by ``size``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c / F.lit(size)).cast("bigint")


def count_histogram(counts: DataFrame, count: str = "count",
                    size: int = BUCKET_SIZE) -> DataFrame:
    """``(bucket, n_keys)``: how many keys have a count in each bucket."""
    return (counts.groupBy(bucket_of(count, size).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n_keys")))


def bucket_moves(count: str, prev: str, size: int = BUCKET_SIZE):
    """``(bucket, delta)`` changes of a key whose count moved: +1 on its new bucket,
    -1 on the old one; up to two from one pass over the updates."""
    new_b, old_b = bucket_of(count, size), bucket_of(prev, size)
    step = lambda b, d: F.struct(b.alias("bucket"), F.lit(d).alias("delta"))
    return F.when(F.col(prev).isNull(), F.array(step(new_b, 1))).when(
        new_b != old_b, F.array(step(new_b, 1), step(old_b, -1)))


def histogram_deltas(updates: DataFrame, batch: str = "batch_id",
                     count: str = "count", prev: str = "prev_count",
                     size: int = BUCKET_SIZE) -> DataFrame:
    """Histogram kept by deltas, as an update feed.

    ``updates`` is the output of :func:`count_with_prev`. A key seen for the
    first time adds 1 to its bucket; a key that moved adds 1 to the new bucket
    and -1 to the old one. Returns, per batch, every bucket touched in that
    batch with its running number of keys; a bucket emptied by moves stays
    with 0.
    """
    moves = bucket_moves(count, prev, size)
    touched = (updates.select(batch, F.inline(moves)).groupBy(batch, "bucket")
               .agg(F.sum("delta").alias("delta")))
    w = (Window.partitionBy("bucket").orderBy(batch)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return touched.select(batch, "bucket",
                          F.sum("delta").over(w).cast("bigint").alias("n_keys"))


def zero_filled_counts(dim: DataFrame, facts: DataFrame, key: str,
                       fact_key: str | None = None, name: str = "count") -> DataFrame:
    """Every key of ``dim`` with its number of fact rows, 0 when unseen.

    The facts are counted first (partial aggregation, one row per key), so
    the join that follows moves one row per key rather than every fact.
    """
    fact_key = fact_key or key
    counted = (facts.groupBy(F.col(fact_key).alias(key))
               .agg(F.count(F.lit(1)).alias(name)))
    return (dim.join(counted, key, "left")
            .withColumn(name, F.coalesce(F.col(name), F.lit(0)).cast("bigint")))

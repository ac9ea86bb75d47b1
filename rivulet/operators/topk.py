"""Rankings: top-N, lowest-N per group and first-N per partition.

``row_number() <= n`` over a window is planned by Spark as a WindowGroupLimit:
a partial limit runs in every map task before the exchange, so a group that
holds a third of all rows ships at most ``n`` rows per task, and the final
per-group sort only sees those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(order) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def top_n(df: DataFrame, n: int, order, by=(), rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each ``by`` group under ``order`` (ties broken
    by the later order columns; give enough of them for a total order)."""
    if n <= 0:
        raise ValueError("n must be positive")
    w = Window.partitionBy(*by).orderBy(*_order(order)) if by else \
        Window.orderBy(*_order(order))
    if not by:
        # A global ranking: Spark plans orderBy+limit as TakeOrderedAndProject
        # (per-task top-n, then a merge of n rows per task).
        return (df.orderBy(*_order(order)).limit(n)
                .withColumn(rank, F.row_number().over(w).cast("bigint")))
    # Filter on the bare row_number so Spark infers the WindowGroupLimit,
    # then widen the rank to bigint.
    return (df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)
            .withColumn(rank, F.col(rank).cast("bigint")))


def top_by_count(counts: DataFrame, obj: str, n: int, by=(), count: str = "count",
                 rank: str = "rank") -> DataFrame:
    """Rolling/total rankings: highest count first, then object ascending."""
    return top_n(counts.where(F.col(count) > 0), n,
                 [F.col(count).desc(), F.col(obj).asc()], by=by, rank=rank)


def lowest_n_per_group(df: DataFrame, group: str, link: str, number: str,
                       n: int, carry=(), rank: str = "rank") -> DataFrame:
    """The ``n`` smallest numbers per group, one entry per link.

    A link seen several times keeps its smallest number (with the columns in
    ``carry`` taken from that row). Ties on the number go to the earlier
    link, the batch stand-in for arrival order.
    """
    best = (df.groupBy(group, link)
            .agg(F.min(F.struct(F.col(number).alias("_n"),
                                *[F.col(c).alias(c) for c in carry])).alias("_b"))
            .select(group, link, F.col("_b._n").alias(number),
                    *[F.col(f"_b.{c}").alias(c) for c in carry]))
    return top_n(best, n, [F.col(number).asc(), F.col(link).asc()], by=[group], rank=rank)


def first_n_per_partition(df: DataFrame, by: str, field: str, n: int = 1,
                          ascending: bool = True, rank: str = "rank") -> DataFrame:
    """First ``n`` rows per ``by`` value, sorted by ``field``."""
    o = F.col(field).asc() if ascending else F.col(field).desc()
    return top_n(df, n, [o], by=[by], rank=rank)

"""Joins: natural N-way, time-bounded, lookup, keyed and temporal proximity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: the proximity flag fires when two times are strictly less than
# 1,800,000 ms (30 minutes) apart.
NEAR_WITHIN_MS = 1_800_000


def natural_join(sides: list[DataFrame], out_fields: list[str],
                 strict: bool = False) -> DataFrame:
    """Inner join of all ``sides`` on the fields they all share.

    The key is the intersection of every side's columns; a non-key column
    present on several sides is taken from the first side that has it. Only
    ``out_fields`` are returned; asking for a field no side has is an error
    at setup, as in the reference. With ``strict`` a key that matches more
    than once on some side raises at run time (the reference rejects a second
    row for a pending key); the check is a window over the join output, which
    is already partitioned by the key after a shuffle join.
    """
    if len(sides) < 2:
        raise ValueError("natural_join needs at least two inputs")
    keys = set(sides[0].columns)
    for s in sides[1:]:
        keys &= set(s.columns)
    keys = [c for c in sides[0].columns if c in keys]
    if not keys:
        raise ValueError("inputs share no field to join on")
    available = {c for s in sides for c in s.columns}
    missing = [f for f in out_fields if f not in available]
    if missing:
        raise ValueError(f"output fields not produced by any input: {missing}")

    def step(acc: DataFrame, side: DataFrame) -> DataFrame:
        extra = [c for c in side.columns if c in keys or c not in acc.columns]
        return acc.join(side.select(*extra), keys, "inner")

    joined = reduce(step, sides)
    if strict:
        n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
        joined = (joined.withColumn("_matches", n)
                  .where(F.when(F.col("_matches") > 1,
                                F.raise_error(F.lit("duplicate input for a join key")))
                         .otherwise(F.lit(True)))
                  .drop("_matches"))
    return joined.select(*out_fields)


def time_bounded_join(left: DataFrame, right: DataFrame, keys: list[str],
                      left_ts: str, right_ts: str, within_seconds: int,
                      how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` whose two times are at most ``within_seconds`` apart.

    Written as a range on the right time so that Structured Streaming can
    derive state eviction from both watermarks (the reference's expiring
    pending-side cache). ``how="left_outer"`` keeps left rows whose partner
    never arrived in time.
    """
    l, r = left.alias("l"), right.alias("r")
    span = F.expr(f"INTERVAL {int(within_seconds)} SECONDS")
    cond = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys]
    cond.append(F.col(f"r.{right_ts}").between(F.col(f"l.{left_ts}") - span,
                                               F.col(f"l.{left_ts}") + span))
    return l.join(r, reduce(lambda a, b: a & b, cond), how)


def lookup_join(requests: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """Static one-to-many lookup: each request row once per member of its key.

    ``edges`` is the normalised form of a key -> list map. Catalyst broadcasts
    it when its size is under the broadcast threshold; otherwise it is a
    shuffle join.
    """
    return requests.join(edges, key, "inner")


def keyed_lookup(requests: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Batch get by composite key; a missing key gives NULL values."""
    return requests.join(table, keys, "left")


# A stored summary with at most so many rows (some 40 bytes each) is broadcast.
SUMMARY_BROADCAST_ROWS = 1_000_000
# Copies of a larger summary, so that one bucket's messages spread over as many tasks.
SUMMARY_SALTS = 32


def near_summary(events: DataFrame, event_ms: str, within_ms: int = NEAR_WITHIN_MS) -> DataFrame:
    """What a bucket of messages must know of the events around it.

    Times are cut into buckets of ``within_ms``. Any two times in one bucket are
    closer than that, so a message is near if its own bucket has an event, or the
    latest event of the bucket before is close enough, or the earliest event of the
    bucket after is. The events are first reduced to one row per bucket, then spread
    to the three message buckets each can serve and reduced again."""
    per_bucket = (events
                  .select(F.floor(F.col(event_ms) / F.lit(int(within_ms))).alias("b"),
                          F.col(event_ms).alias("t"))
                  .where(F.col("t").isNotNull())
                  .groupBy("b").agg(F.min("t").alias("lo"), F.max("t").alias("hi")))
    none = F.lit(None).cast("bigint")

    def serves(step: int, same: bool, prev_hi, next_lo):
        return F.struct((F.col("b") + step).alias("mb"), F.lit(same).alias("same"),
                        prev_hi.cast("bigint").alias("prev_hi"),
                        next_lo.cast("bigint").alias("next_lo"))

    spread = per_bucket.select(F.explode(F.array(
        serves(0, True, none, none), serves(1, False, F.col("hi"), none),
        serves(-1, False, none, F.col("lo")))).alias("s")).select("s.*")
    return spread.groupBy("mb").agg(F.max("same").alias("_same"),
                                    F.max("prev_hi").alias("_prev_hi"),
                                    F.min("next_lo").alias("_next_lo"))


def stored_near_summary(events: DataFrame, event_ms: str, path: str,
                        within_ms: int = NEAR_WITHIN_MS) -> DataFrame:
    """:func:`near_summary` written once, for streams that join it in every
    micro-batch: broadcast if it has at most ``SUMMARY_BROADCAST_ROWS`` rows, else
    copied under ``SUMMARY_SALTS`` salts (a stream's recent messages share a bucket,
    and a stateful plan is not re-split at run time)."""
    near_summary(events, event_ms, within_ms).write.parquet(path)
    summary = events.sparkSession.read.parquet(path)
    if summary.count() <= SUMMARY_BROADCAST_ROWS:
        return F.broadcast(summary)
    return summary.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SUMMARY_SALTS - 1))))


def flag_by_summary(messages: DataFrame, summary: DataFrame, msg_ms: str,
                    within_ms: int = NEAR_WITHIN_MS, name: str = "near") -> DataFrame:
    """Messages with ``name``: each joins the one summary row of its bucket, or none."""
    t, width = F.col(msg_ms), F.lit(int(within_ms))
    on = ["mb"]
    keyed = messages.withColumn("mb", F.floor(t / width))
    if "_salt" in summary.columns:
        on.append("_salt")
        keyed = keyed.withColumn("_salt", F.pmod(
            F.xxhash64(*messages.columns), F.lit(SUMMARY_SALTS)).cast("int"))
    flagged = keyed.join(summary, on, "left")
    near = (F.coalesce(F.col("_same"), F.lit(False))
            | F.coalesce(F.col("_prev_hi") > t - width, F.lit(False))
            | F.coalesce(F.col("_next_lo") < t + width, F.lit(False)))
    # A message without a time cannot be near anything.
    near = F.when(t.isNull(), F.lit(False)).otherwise(near)
    return flagged.withColumn(name, near).drop(*on, "_same", "_prev_hi", "_next_lo")


def near_flag(messages: DataFrame, events: DataFrame, msg_ms: str,
              event_ms: str, within_ms: int = NEAR_WITHIN_MS,
              name: str = "near") -> DataFrame:
    """Flag each message that has an event strictly within ``within_ms``: exact, and
    without pairing messages with events (see :func:`near_summary`)."""
    return flag_by_summary(messages, near_summary(events, event_ms, within_ms), msg_ms,
                           within_ms, name)

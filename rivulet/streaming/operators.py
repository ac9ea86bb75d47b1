"""Structured Streaming building blocks.

* :func:`run_available` drives a query over everything available now and
  stops (bounded wait, the query is always stopped).
* :func:`feed_writer` appends what every micro-batch emits to a
  :class:`~rivulet.sinks.tables.BatchLog`, one partition per batch id: a batch
  that is replayed after a failure overwrites its own output, and Spark's state
  store replays it from the state before it, so nothing counts twice.
* The stateful operators hold their state in the state store: Spark's own
  aggregation where it expresses the job (:func:`running_total`,
  :func:`latest_by`), :mod:`rivulet.streaming.state` otherwise. What a batch
  writes is what it changed, whatever the size of the table.

Event-time operators take ``delay``, how late the caller knows rows to be at
most; it bounds the state. Rows beyond it come out as ``late`` or ``expired``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from rivulet.operators.aggregates import bucket_of, bucket_moves
from rivulet.operators.windows import window_geometry
from rivulet.session import keyed_state_store
from rivulet.sinks.tables import BatchLog
from rivulet.streaming import state as ST


# Keys of time-bounded state, and of counts, are kept in so many keys of the state store: each
# costs a micro-batch that touches it about two milliseconds of a core, however few its rows.
BUCKETS = 1024


class StreamTimeout(RuntimeError):
    pass


def run_available(writer, timeout_s: int = 900):
    """Start ``writer`` with an ``availableNow`` trigger and wait for it."""
    q = writer.trigger(availableNow=True).start()
    try:
        finished = q.awaitTermination(timeout_s)
        if not finished:
            raise StreamTimeout(f"stream did not finish within {timeout_s}s")
        if q.exception() is not None:
            raise q.exception()
    finally:
        if q.isActive:
            q.stop()
    return q


def feed_writer(df: DataFrame, feed: BatchLog, checkpoint: str, by: str | None = None):
    """Update-mode stream into a feed of changes; ``by`` splits each batch's
    partition once more, so that kinds of rows are read apart."""
    def apply(batch_df: DataFrame, batch_id: int) -> None:
        feed.write(batch_df, batch_id, by)

    return (df.writeStream.outputMode("update").foreachBatch(apply)
            .option("checkpointLocation", checkpoint))


def _ms(ts: str) -> Column:
    return F.unix_millis(F.col(ts).cast("timestamp"))


def _zoned(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """``df`` with a watermark ``delay`` behind its column ``ts`` (UTC wall time or zoned)."""
    if df.schema[ts].dataType.simpleString() != "timestamp":
        df = df.withColumn(ts, F.timestamp_millis(F.timestamp_diff(
            "MILLISECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts))))
    return df.withWatermark(ts, delay)


def wall_clock(ms: str) -> Column:
    """UTC wall time of epoch milliseconds."""
    return F.timestamp_add("MILLISECOND", F.col(ms), F.lit("1970-01-01").cast("timestamp_ntz"))


# ------------------------------------------------------------ keyed state

def _with_state(df: DataFrame, keys: list[str], processor: StatefulProcessor, schema: str,
                clock: str = "none") -> DataFrame:
    """``processor`` per key, in update mode, on a state store that can hold it."""
    keyed_state_store(df.sparkSession)
    return df.groupBy(*keys).transformWithState(processor, schema, "Update", clock)


def _with_bucketed_state(df: DataFrame, keys: list[str], processor: StatefulProcessor,
                         schema: str) -> DataFrame:
    """``processor`` per key by event time, its keys held in ``BUCKETS`` values."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))
    return _with_state(df.withColumn("_bucket", bucket), ["_bucket"],
                       ST.Bucketed(keys, processor), schema, "eventTime")


def running_total(df: DataFrame) -> DataFrame:
    """Exactly-once running row count, one row per micro-batch."""
    return df.groupBy().agg(F.count(F.lit(1)).alias("count"))


def latest_by(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Keyed upserts: per key the row with the greatest ``order`` so far, whatever
    the order of arrival. Emits the keys of each micro-batch."""
    values = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*[F.col(c) for c in values]), F.col(order)).alias("_v")
    return df.groupBy(*keys).agg(best).select(*keys, "_v.*")


def keyed_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys..., count, prev_count)`` of every key of a micro-batch: the running
    count and the one before it (null on first sight). The keys are held in ``BUCKETS``
    buckets, whose rows are packed on both sides of the state."""
    counts = ST.partial_counts(df, keys).withColumn("_hash", F.xxhash64(*keys))
    rows = ST.packed(counts.withColumn("_bucket", F.pmod("_hash", F.lit(BUCKETS))), "_bucket")
    out = [*keys, "count", "prev_count"]
    types = ", ".join([*(f"`{k}` array<{df.schema[k].dataType.simpleString()}>" for k in keys),
                       "count array<bigint>, prev_count array<bigint>"])
    counted = _with_state(rows, ["_bucket"], ST.KeyedCounts(keys, BUCKETS), types)
    return counted.select(F.inline(F.arrays_zip(*out)).alias(*out))


def keyed_fold(df: DataFrame, keys: list[str], value_type: str, step) -> DataFrame:
    """Keyed state with the caller's fold. ``value_type`` is the state's schema
    (``name type, ...``), ``step(old, row) -> new`` makes it from the old one (a
    tuple, None at first) and an input row."""
    columns = [c.strip().split()[0] for c in value_type.split(",")]
    return _with_state(df, keys, ST.Folded(keys, columns, value_type, step),
                       f"{ST._types(df, keys)}, {value_type}")


def histogram(updates: DataFrame, size: int | None = None) -> DataFrame:
    """Histogram of running counts, kept by deltas: ``updates`` (of
    :func:`keyed_counts`) becomes +1 on a key's new bucket and -1 on its old one,
    summed per bucket by a second stateful step. Emits ``(bucket, n_keys)`` of the
    buckets a micro-batch touched; an emptied bucket stays with 0."""
    moves = bucket_moves("count", "prev_count", *([size] if size else []))
    return (updates.select(F.inline(moves)).groupBy("bucket")
            .agg(F.sum("delta").cast("bigint").alias("n_keys")))


def lowest_n(df: DataFrame, group: str, link: str, number: str, n: int, carry=()) -> DataFrame:
    """Per-group lowest-N lists as state; emits ``(group, number, link, carry...)`` of
    the entries that entered a list. One entry per link, its smallest number; ties
    to the earlier link."""
    columns = [number, link, *carry]
    entry = ",".join(f"{c}:{df.schema[c].dataType.simpleString()}" for c in columns)
    return _with_state(ST.partial_lowest(df, group, link, number, n, carry), [group],
                       ST.LowestN(group, columns, n, entry), ST._types(df, [group, *columns]))


# ------------------------------------------------------------ rankings

def top_n(counts: DataFrame, obj: str, n: int, by=(), end: str | None = None,
          buckets: int = 32) -> DataFrame:
    """Two-level ranking of growing counts: ``(by..., obj, count)`` updates go into a
    bounded list per ``by`` group and bucket of objects, and the changes of those
    lists into one list per group, emitted whole as ``(by..., rank, obj, count)``
    when it changes. ``end`` names the ``by`` column (milliseconds) at which a group's
    lists are dropped."""
    by = list(by)
    kind = counts.schema[obj].dataType.simpleString()
    types = ST._types(counts, by)
    clock = "eventTime" if end else "none"
    at = by.index(end) if end else None
    bucketed = (counts.where(F.col("count") > 0)
                .withColumn("_bucket", F.pmod(F.xxhash64(obj), F.lit(buckets))))
    partial = _with_state(
        ST.partial_highest(bucketed, [*by, "_bucket"], obj, n), [*by, "_bucket"], ST.RankList([*by, "_bucket"], obj, n, kind, False, at),
        ", ".join(filter(None, [types, f"_bucket bigint, `{obj}` {kind}, count bigint"])), clock)
    merged = partial.drop("_bucket") if by else partial.withColumn("_all", F.lit(0))
    keys = by or ["_all"]
    return _with_state(merged, keys, ST.RankList(keys, obj, n, kind, True, at),
                       f"{types or '_all int'}, rank bigint, `{obj}` {kind}, count bigint",
                       clock).drop("_all")


# ------------------------------------------------------------ windows

def window_counts(df: DataFrame, ts: str, keys: list[str], window_seconds: int,
                  emit_seconds: int, delay: str, updates: bool = False,
                  weight: str | None = None) -> DataFrame:
    """Sliding-window counts per key: ``(kind, keys..., end_ms, count)``.

    ``kind`` is ``count`` (at the tick that ends the window), ``zero`` (once, at the
    tick after the last window with a row) or ``late`` (rows whose slot had ended by
    the watermark; counted nowhere). With ``updates``, ``update`` instead of the
    first two: the present count of each window a micro-batch touched. Rows are
    counted per slot before the shuffle. ``weight``: a column to sum instead of
    counting rows; rows of weight 0 only move the time on."""
    slots, width = window_geometry(window_seconds, emit_seconds)
    emit = emit_seconds * 1000
    timed = _zoned(df, ts, delay)
    slotted = timed.where(F.col(ts).isNotNull()).withColumn(
        "slot", _ms(ts) - F.pmod(_ms(ts), F.lit(emit)))
    counted = ST.partial_counts(slotted, [*keys, "slot"], weight)
    return _with_bucketed_state(
        counted, keys, ST.WindowCounts(keys, width * 1000, emit, updates),
        f"kind string, {ST._types(df, keys)}, end_ms bigint, count bigint")


def rolling_top_n(df: DataFrame, ts: str, obj: str, n: int, window_seconds: int,
                  emit_seconds: int, delay: str, weight: str | None = None) -> DataFrame:
    """Rolling top-N: window counts, a bounded list per window and bucket, one list
    per window. Emits ``(window_end, rank, obj, count)`` of windows whose list changed."""
    counts = window_counts(df, ts, [obj], window_seconds, emit_seconds, delay, True, weight)
    ranked = top_n(counts.where("kind = 'update'").drop("kind"), obj, n, ["end_ms"], "end_ms")
    return ranked.select(wall_clock("end_ms").alias("window_end"), "rank", obj, "count")


# ------------------------------------------------------------ joins

def natural_join(sides: list[DataFrame], out_fields: list[str], ts: str | None = None,
                 within_seconds: int | None = None, delay: str | None = None) -> DataFrame:
    """N-way natural inner join of streams on the fields that all of them have.

    A result is emitted when the last of its sides has come (``kind`` = ``joined``);
    a second row of a side while its key is pending is an error. With ``ts`` (a
    column of every side, not part of the key), ``within_seconds`` and ``delay``, the
    rows of a result lie at most ``within_seconds`` apart, and pending sides that can
    no longer be completed come out as ``expired``, with ``sides`` the bits of those
    that had come. A row whose key is null only moves the time on. Returns
    ``(kind, sides, out_fields...)``."""
    if len(sides) < 2:
        raise ValueError("natural_join needs at least two inputs")
    if (ts is None) != (within_seconds is None) or (ts is None) != (delay is None):
        raise ValueError("expiry needs ts, within_seconds and delay")
    common = set.intersection(*(set(s.columns) for s in sides)) - {ts}
    keys = [c for c in sides[0].columns if c in common]
    if not keys:
        raise ValueError("inputs share no field to join on")
    owners: dict[str, int] = {}
    for i, s in enumerate(sides):
        for c in s.columns:
            owners.setdefault(c, i)
    missing = [f for f in out_fields if f not in owners]
    if missing:
        raise ValueError(f"output fields not produced by any input: {missing}")
    fields = [f for f in out_fields if f not in keys]

    def tagged(i: int, side: DataFrame) -> DataFrame:
        if ts is not None:
            side = _zoned(side, ts, delay)
        null_key = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
        known = lambda f: (F.col(f) if owners[f] == i else F.lit(None).cast(
            sides[owners[f]].schema[f].dataType))
        tag = F.when(null_key, F.lit(-1)).otherwise(F.lit(i))
        out = side.select(*keys, tag.cast("int").alias("side"),
                          (_ms(ts) if ts else F.lit(None).cast("bigint")).alias("at"),
                          *[known(f).alias(f) for f in fields])
        return out if ts is not None else out.where("side >= 0")

    both = reduce(DataFrame.unionByName, (tagged(i, s) for i, s in enumerate(sides)))
    types = ", ".join(f"`{f}` {sides[owners[f]].schema[f].dataType.simpleString()}"
                      for f in fields)
    processor = ST.NaturalJoin(keys, fields, len(sides),
                               None if within_seconds is None else within_seconds * 1000,
                               types, {f: owners[f] for f in fields})
    schema = ", ".join(filter(None, ["kind string, sides int", ST._types(sides[0], keys), types]))
    joined = (_with_state(both, keys, processor, schema) if ts is None
              else _with_bucketed_state(both, keys, processor, schema))
    return joined.select("kind", "sides", *out_fields)

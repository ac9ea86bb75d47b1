"""Sliding-window counts over event time (batch form).

The reference keeps ``slots`` per object and emits every ``emit`` seconds
the sum of the last ``slots`` slots. Here the raw rows are first counted per
tumbling slot (a partial aggregate, so a hot object is collapsed map-side),
and only those per-slot counts are spread to the ``slots`` windows they
belong to. Spark's sliding ``window()`` would instead copy every raw row
``slots`` times before aggregating. Windows are aligned to the epoch, as
Spark's ``window()`` is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Default window length and emit frequency of the rolling
# counter (seconds); fewer than two slots is not allowed.
DEFAULT_WINDOW_SECONDS = 300
DEFAULT_EMIT_SECONDS = 60
MIN_SLOTS = 2


def window_geometry(window_seconds: int, emit_seconds: int) -> tuple[int, int]:
    """``(slots, effective_width_seconds)``: slots = max(W // E, 2)."""
    if emit_seconds <= 0:
        raise ValueError("emit frequency must be positive")
    slots = max(window_seconds // emit_seconds, MIN_SLOTS)
    return slots, slots * emit_seconds


def _seconds(n: int):
    return F.expr(f"INTERVAL {int(n)} SECONDS")


def slot_count(df: DataFrame, ts: str, keys: list[str], slot_seconds: int) -> DataFrame:
    """Tumbling counts: ``(keys..., slot_start, slot_end, count)``."""
    w = F.window(ts, f"{int(slot_seconds)} seconds")
    return (df.groupBy(*keys, w.alias("w"))
            .agg(F.count(F.lit(1)).alias("count"))
            .select(*keys, F.col("w.start").alias("slot_start"),
                    F.col("w.end").alias("slot_end"), "count"))


def rolling_count(df: DataFrame, ts: str, keys: list[str],
                  window_seconds: int = DEFAULT_WINDOW_SECONDS,
                  emit_seconds: int = DEFAULT_EMIT_SECONDS) -> DataFrame:
    """``(keys..., window_end, count)`` for every window with a row.

    ``window_end`` is the tick at which the reference would emit the count.
    """
    slots, _ = window_geometry(window_seconds, emit_seconds)
    per_slot = slot_count(df, ts, keys, emit_seconds)
    spread = per_slot.select(
        *keys, "count",
        F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("k"),
        F.col("slot_end").alias("slot_end"))
    spread = spread.withColumn(
        "window_end", F.col("slot_end") + F.col("k") * _seconds(emit_seconds))
    return (spread.groupBy(*keys, "window_end")
            .agg(F.sum("count").cast("bigint").alias("count")))


def with_zero_rows(counts: DataFrame, keys: list[str], emit_seconds: int,
                   end: str = "window_end", count: str = "count") -> DataFrame:
    """Add the single zero row emitted when an object leaves the window.

    The reference reads the counts before wiping objects whose total became
    zero, so after the last non-empty window of a run the next tick reports
    0 once. Rows per key are windows (bounded by the time span), not events.
    """
    w = Window.partitionBy(*keys).orderBy(end)
    nxt = F.lead(end).over(w)
    step = _seconds(emit_seconds)
    here = F.struct(F.col(end).alias(end), F.col(count).cast("bigint").alias(count))
    zero = F.struct((F.col(end) + step).alias(end), F.lit(0).cast("bigint").alias(count))
    leaves = F.col("_next").isNull() | (F.col("_next") != F.col(end) + step)
    # One pass: a row that leaves the window carries its zero row along.
    return (counts.select(*keys, end, count, nxt.alias("_next"))
            .select(*keys, F.inline(F.when(leaves, F.array(here, zero)).otherwise(F.array(here)))))


def with_window_length(counts: DataFrame, events: DataFrame, ts: str,
                       window_seconds: int, emit_seconds: int,
                       end: str = "window_end",
                       name: str = "window_length_seconds") -> DataFrame:
    """Actual window length at each tick during warm-up.

    The counter starts at the slot of the earliest event; at tick k the
    window covers min(k, slots) slots. The earliest slot is one number,
    fetched by a small aggregation job and used as a literal.
    """
    _, width = window_geometry(window_seconds, emit_seconds)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = lambda c: F.timestamp_diff("SECOND", epoch, c)
    t0 = events.agg(seconds(F.min(ts)).alias("s")).first()["s"]
    if t0 is None:
        return counts.withColumn(name, F.lit(None).cast("bigint"))
    first_start = (int(t0) // emit_seconds) * emit_seconds
    length = F.least(F.lit(width).cast("bigint"),
                     seconds(F.col(end)) - F.lit(first_start).cast("bigint"))
    return counts.withColumn(name, length)

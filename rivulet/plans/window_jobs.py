"""Sliding-window queries over ``events`` (window 9 h, emitted every 3 h)."""

from __future__ import annotations

from rivulet.operators import topk as TK
from rivulet.operators import windows as WN
from rivulet.plans.registry import register
from rivulet.session import table

WINDOW_S = 9 * 3600
EMIT_S = 3 * 3600


def _slots_sql(keys: str) -> str:
    return f"""
  SELECT {keys}, time_bucket(INTERVAL 3 HOUR, ts, TIMESTAMP '1970-01-01') AS slot_start,
         count(*) AS n
  FROM events GROUP BY ALL"""


def _rolling_sql(keys: str) -> str:
    return f"""
  SELECT {keys}, slot_start + to_hours(3 * (k + 1)) AS window_end,
         CAST(sum(n) AS BIGINT) AS count
  FROM ({_slots_sql(keys)}) s, (SELECT unnest([0, 1, 2]) AS k) ks
  GROUP BY ALL"""


@register("rolling_count", _rolling_sql("event_type"))
def rolling_count(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return WN.rolling_count(ev, "ts", ["event_type"], WINDOW_S, EMIT_S)


@register("rolling_count_zeros", f"""
WITH c AS ({_rolling_sql("event_type, user_id")}),
z AS (SELECT event_type, user_id, window_end + INTERVAL 3 HOUR AS window_end,
             CAST(0 AS BIGINT) AS count
      FROM (SELECT *, lead(window_end) OVER (PARTITION BY event_type, user_id
                                             ORDER BY window_end) AS nxt FROM c)
      WHERE nxt IS NULL OR nxt <> window_end + INTERVAL 3 HOUR)
SELECT event_type, user_id, window_end, count FROM c
UNION ALL SELECT event_type, user_id, window_end, count FROM z""")
def rolling_count_zeros(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    keys = ["event_type", "user_id"]
    return WN.with_zero_rows(WN.rolling_count(ev, "ts", keys, WINDOW_S, EMIT_S), keys, EMIT_S)


@register("rolling_window_length", f"""
SELECT event_type, window_end, count,
       CAST(least(32400, epoch(window_end) - epoch(
           (SELECT time_bucket(INTERVAL 3 HOUR, min(ts), TIMESTAMP '1970-01-01') FROM events)))
            AS BIGINT) AS window_length_seconds
FROM ({_rolling_sql("event_type")})""")
def rolling_window_length(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    counts = WN.rolling_count(ev, "ts", ["event_type"], WINDOW_S, EMIT_S)
    return WN.with_window_length(counts, ev, "ts", WINDOW_S, EMIT_S)


@register("slot_count", """
SELECT event_type, time_bucket(INTERVAL 3 HOUR, ts, TIMESTAMP '1970-01-01') AS slot_start,
       time_bucket(INTERVAL 3 HOUR, ts, TIMESTAMP '1970-01-01') + INTERVAL 3 HOUR AS slot_end,
       count(*) AS count
FROM events GROUP BY ALL""")
def slot_count(spark, sf_dir):
    return WN.slot_count(table(spark, sf_dir, "events"), "ts", ["event_type"], EMIT_S)


@register("rolling_top_n", f"""
SELECT window_end, user_id, count, rank FROM (
  SELECT window_end, user_id, count,
         row_number() OVER (PARTITION BY window_end ORDER BY count DESC, user_id ASC) AS rank
  FROM ({_rolling_sql("user_id")}))
WHERE rank <= 5""")
def rolling_top_n(spark, sf_dir):
    """Rolling top 5 users per window tick (count desc, then user asc)."""
    ev = table(spark, sf_dir, "events")
    counts = WN.rolling_count(ev, "ts", ["user_id"], WINDOW_S, EMIT_S)
    return TK.top_by_count(counts, "user_id", 5, by=["window_end"]).select(
        "window_end", "user_id", "count", "rank")

"""Structured Streaming forms of the jobs.

Each query runs a streaming query over the driver tables (``availableNow``) and
returns what it landed: a feed of changes written through ``foreachBatch``, or a
file sink. State lives in the state store, and a micro-batch writes what it
changed. Jobs whose micro-batches matter land their input batch by batch; jobs
with event-time timers land it in order of arrival, each row up to ``JITTER_S``
after its time, with a last heartbeat that moves the time past every window.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from rivulet.functions import records as RC
from rivulet.functions import text as TX
from rivulet.operators import aggregates as AG
from rivulet.operators import joins as JN
from rivulet.operators import bayes as BY
from rivulet.plans import derived as DV
from rivulet.plans import quake as QK
from rivulet.plans import table_jobs as TJ
from rivulet.plans.derived import listings, render_stock_lines
from rivulet.plans.registry import register
from rivulet.plans.window_jobs import EMIT_S, WINDOW_S
from rivulet.session import scratch_path, table
from rivulet.sinks.tables import BatchLog
from rivulet.sources import documents as DOC
from rivulet.streaming import operators as SO
from rivulet.streaming import sources as SS
from rivulet.plans.text_jobs import _JAVA_WORDS as JAVA_WORDS_SQL

N_BATCHES = 3


def _paths(spark, name):
    root = scratch_path(spark, name)
    return root, os.path.join(root, "_checkpoint")


def _feed(spark, root, name="feed"):
    return BatchLog(spark, os.path.join(root, name))


# ------------------------------------------------------------ aggregations

@register("stream_word_count", f"""
SELECT word, count(*) AS count FROM ({JAVA_WORDS_SQL}) GROUP BY word""")
def stream_word_count(spark, sf_dir):
    """Running word counts: each micro-batch appends the counts it changed."""
    root, ckpt = _paths(spark, "stream_word_count")
    docs = SS.table_stream(spark, sf_dir, "documents")
    counts = AG.word_count(docs, "text", "java")
    out = _feed(spark, root)
    SO.run_available(SO.feed_writer(counts, out, ckpt))
    return out.latest(["word"])


@register("stream_max_by_symbol", """
SELECT l_returnflag AS exchange, CAST(l_suppkey AS VARCHAR) AS symbol,
       max(l_extendedprice * l_quantity) AS market_cap
FROM lineitem GROUP BY l_returnflag, l_suppkey""")
def stream_max_by_symbol(spark, sf_dir):
    """Max traded value per (exchange, symbol) with an update feed."""
    root, ckpt = _paths(spark, "stream_max_by_symbol")
    lines = render_stock_lines(SS.table_stream(spark, sf_dir, "lineitem"))
    best = AG.max_by_key(RC.parse_stock_line(lines), ["exchange", "symbol"],
                         "market_cap", "market_cap")
    out = _feed(spark, root)
    SO.run_available(SO.feed_writer(best, out, ckpt))
    return out.latest(["exchange", "symbol"])


# Rows arrive up to this long after their time, in this many landed batches.
JITTER_S = 6 * 3600
ARRIVALS = 4


def _arriving(df, root, ts="ts", key="event_id", name="landing"):
    """``df`` as a stream in order of arrival, then a heartbeat (``weight`` 0, all
    other columns null); with the lateness it keeps."""
    rows, delay = DV.in_arrival_order(df, ts, key, ARRIVALS, JITTER_S)
    return SS.landed_stream(rows, "batch", ARRIVALS + 1, os.path.join(root, name)), delay


def _window_feed(spark, sf_dir, name, keys):
    """Window counts of the events, at each tick, and the zero rows."""
    root, ckpt = _paths(spark, name)
    stream, delay = _arriving(table(spark, sf_dir, "events"), root)
    counts = SO.window_counts(stream, "ts", keys, WINDOW_S, EMIT_S, delay, weight="weight")
    out = _feed(spark, root)
    SO.run_available(SO.feed_writer(counts, out, ckpt, by="kind"))
    return out.read().select("kind", *keys, SO.wall_clock("end_ms").alias("window_end"), "count")


@register("stream_rolling_count", """
SELECT event_type, slot_start + to_hours(3 * (k + 1)) AS window_end,
       CAST(sum(n) AS BIGINT) AS count
FROM (SELECT event_type, time_bucket(INTERVAL 3 HOUR, ts, TIMESTAMP '1970-01-01') AS slot_start,
             count(*) AS n FROM events GROUP BY ALL) s,
     (SELECT unnest([0, 1, 2]) AS k) ks
GROUP BY ALL""")
def stream_rolling_count(spark, sf_dir):
    """Sliding event-time window counts (9 h every 3 h), emitted at the tick that
    ends the window; rows arrive up to ``JITTER_S`` late."""
    feed = _window_feed(spark, sf_dir, "stream_rolling_count", ["event_type"])
    return feed.where("kind = 'count'").drop("kind")


@register("stream_rolling_top_n", """
SELECT window_end, user_id, count, rank FROM (
  SELECT window_end, user_id, count,
         row_number() OVER (PARTITION BY window_end ORDER BY count DESC, user_id ASC) AS rank
  FROM (SELECT user_id, slot_start + to_hours(3 * (k + 1)) AS window_end,
               CAST(sum(n) AS BIGINT) AS count
        FROM (SELECT user_id, time_bucket(INTERVAL 3 HOUR, ts, TIMESTAMP '1970-01-01')
                       AS slot_start, count(*) AS n FROM events GROUP BY ALL) s,
             (SELECT unnest([0, 1, 2]) AS k) ks
        GROUP BY ALL))
WHERE rank <= 5""")
def stream_rolling_top_n(spark, sf_dir):
    """Rolling top 5 per window tick: window counts, bounded lists per bucket of
    users, one merged list per window; a changed list is emitted whole."""
    root, ckpt = _paths(spark, "stream_rolling_top_n")
    stream, delay = _arriving(table(spark, sf_dir, "events"), root)
    ranked = SO.rolling_top_n(stream, "ts", "user_id", 5, WINDOW_S, EMIT_S, delay, "weight")
    out = _feed(spark, root)
    SO.run_available(SO.feed_writer(ranked, out, ckpt))
    return out.latest(["window_end", "rank"]).select("window_end", "user_id", "count", "rank")


@register("stream_top_words_global", f"""
SELECT word, count, rank FROM (
  SELECT word, count, row_number() OVER (ORDER BY count DESC, word ASC) AS rank
  FROM (SELECT word, count(*) AS count FROM ({JAVA_WORDS_SQL}) GROUP BY word))
WHERE rank <= 20""")
def stream_top_words_global(spark, sf_dir):
    """The 20 most frequent words of the whole stream: keyed counts, a bounded list
    per bucket of words, and one merge of the lists."""
    root, ckpt = _paths(spark, "stream_top_words_global")
    docs = SS.table_stream(spark, sf_dir, "documents")
    counts = SO.keyed_counts(AG.words(docs, "text", "java"), ["word"])
    out = _feed(spark, root)
    SO.run_available(SO.feed_writer(SO.top_n(counts.drop("prev_count"), "word", 20), out, ckpt))
    return out.latest(["rank"]).select("word", "count", "rank")


# ------------------------------------------------------------ stream join

JOIN_WITHIN_S = 1800


@register("stream_natural_join", """
SELECT c_custkey AS custkey, c_name, first_order, last_event FROM customer
JOIN (SELECT o_custkey, min(o_orderkey) AS first_order FROM orders GROUP BY o_custkey)
  ON o_custkey = c_custkey
JOIN (SELECT user_id, max(event_id) AS last_event FROM events GROUP BY user_id)
  ON user_id = c_custkey""")
def stream_natural_join(spark, sf_dir):
    """Three streams joined on their common field: customers, the first order of
    each and the last event of each, whose sides land in different micro-batches."""
    root, ckpt = _paths(spark, "stream_natural_join")
    sides = [
        table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), "c_name"),
        table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("custkey"))
        .agg(F.min("o_orderkey").alias("first_order")),
        table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("custkey"))
        .agg(F.max("event_id").alias("last_event"))]
    streams = []
    for i, side in enumerate(sides):
        landed = side.withColumn("batch", F.pmod(F.col("custkey") + i, F.lit(N_BATCHES)))
        streams.append(SS.landed_stream(landed, "batch", N_BATCHES, os.path.join(root, f"side_{i}")))
    joined = SO.natural_join(streams, ["custkey", "c_name", "first_order", "last_event"])
    out = _feed(spark, root)
    SO.run_available(SO.feed_writer(joined, out, ckpt))
    return out.read().select("custkey", "c_name", "first_order", "last_event")


@register("stream_join_expiry", """
WITH s AS (SELECT event_id, user_id, value, ts AS l_ts,
                  ts + to_seconds(CAST(floor(value) AS BIGINT) * 10) AS r_ts,
                  coalesce(floor(value) * 10 <= 1800, false) AS meets FROM events)
SELECT event_id, 'joined' AS outcome, CAST(user_id AS DOUBLE) AS user_id, value,
       strftime(l_ts, '%Y-%m-%d %H:%M:%S') AS l_ts, strftime(r_ts, '%Y-%m-%d %H:%M:%S') AS r_ts
FROM s WHERE meets
UNION ALL SELECT event_id, 'left expired', CAST(user_id AS DOUBLE), NULL,
       strftime(l_ts, '%Y-%m-%d %H:%M:%S'), NULL FROM s WHERE NOT meets
UNION ALL SELECT event_id, 'right expired', NULL, value,
       NULL, strftime(r_ts, '%Y-%m-%d %H:%M:%S') FROM s WHERE NOT meets AND r_ts IS NOT NULL""")
def stream_join_expiry(spark, sf_dir):
    """Two streams joined on event_id when their times are within 30 min; the right
    side is the same events floor(value) * 10 s later. Sides whose partner does not
    come in time are expired by a timer and come out as such."""
    root, ckpt = _paths(spark, "stream_join_expiry")
    ev = table(spark, sf_dir, "events")
    later = F.make_dt_interval(secs=F.floor("value").cast("int") * 10)
    left = ev.select("event_id", "ts", "user_id", F.col("ts").alias("l_ts"))
    right = ev.select("event_id", (F.col("ts") + later).alias("ts"), "value").where(
        F.col("ts").isNotNull()).withColumn("r_ts", F.col("ts"))
    # Both sides are landed on one clock, the events' own.
    (l_rows, r_rows), delay = DV.sides_in_arrival_order([left, right], "ts", "event_id", ARRIVALS,
                                                        JITTER_S)
    streams = [SS.landed_stream(rows.drop("weight"), "batch", ARRIVALS + 1, os.path.join(root, name))
               for rows, name in ((l_rows, "left"), (r_rows, "right"))]
    joined = SO.natural_join(streams, ["event_id", "user_id", "value", "l_ts", "r_ts"], "ts",
                             JOIN_WITHIN_S, delay)
    out = _feed(spark, root)
    SO.run_available(SO.feed_writer(joined, out, ckpt, by="kind"))
    outcome = F.when(F.col("kind") == "joined", "joined").when(
        F.col("sides") == 1, "left expired").otherwise("right expired")
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return out.read().select("event_id", outcome.alias("outcome"),
                             F.col("user_id").cast("double").alias("user_id"), "value",
                             text("l_ts"), text("r_ts"))


# ------------------------------------------------------------ micro-batches

def _staged_events(spark, sf_dir, name, start):
    """Runs ``start(stream)`` over events landed as three batches (event_id % 3)."""
    root, ckpt = _paths(spark, name)
    ev = table(spark, sf_dir, "events").withColumn("batch", F.col("event_id") % N_BATCHES)
    for stream in SS.landed_batches(ev, "batch", list(range(N_BATCHES)),
                                    os.path.join(root, "landing")):
        SO.run_available(start(stream, root, ckpt))
    return root


@register("microbatch_source", """
SELECT event_id % 3 AS batch_id, count(*) AS n_rows FROM events GROUP BY 1""")
def microbatch_source(spark, sf_dir):
    """Batched replay source: each micro-batch is one landed batch."""
    def start(stream, root, ckpt):
        out = _feed(spark, root)

        def record(batch_df, batch_id):
            out.write(batch_df.agg(F.count(F.lit(1)).alias("n_rows")), batch_id)

        return stream.writeStream.foreachBatch(record).option("checkpointLocation", ckpt)

    root = _staged_events(spark, sf_dir, "microbatch_source", start)
    return _feed(spark, root).read().select("batch_id", "n_rows")


@register("idempotent_total", """
SELECT batch_id, CAST(sum(n) OVER (ORDER BY batch_id) AS BIGINT) AS count
FROM (SELECT event_id % 3 AS batch_id, count(*) AS n FROM events GROUP BY 1)""")
def idempotent_total(spark, sf_dir):
    """Exactly-once running count after each micro-batch."""
    root = _staged_events(spark, sf_dir, "idempotent_total", lambda stream, root, ckpt:
                          SO.feed_writer(SO.running_total(stream), _feed(spark, root), ckpt))
    return _feed(spark, root).read().select("batch_id", "count")


@register("stream_count_with_prev", TJ._CWP_OUT_SQL)
def stream_count_with_prev(spark, sf_dir):
    """Keyed counts with the previous value, per micro-batch."""
    root = _staged_events(
        spark, sf_dir, "stream_count_with_prev", lambda stream, root, ckpt:
        SO.feed_writer(SO.keyed_counts(stream, ["user_id"]), _feed(spark, root), ckpt))
    return _feed(spark, root).read().select("user_id", "batch_id", "count",
                                            F.col("prev_count").cast("double"))


@register("stream_histogram_deltas", TJ.HISTOGRAM_DELTAS_SQL)
def stream_histogram_deltas(spark, sf_dir):
    """Histogram of the users' event counts, kept by deltas in a second stateful
    step: per micro-batch the buckets it touched."""
    root = _staged_events(
        spark, sf_dir, "stream_histogram_deltas", lambda stream, root, ckpt:
        SO.feed_writer(SO.histogram(SO.keyed_counts(stream, ["user_id"])), _feed(spark, root),
                       ckpt))
    return _feed(spark, root).read().select("batch_id", "bucket", "n_keys")


_LISTING_BATCHES_SQL = r"""
  WITH l AS (SELECT p_brand AS city, CAST(p_partkey AS VARCHAR) AS link, p_partkey % 3 AS b0,
                    TRY_CAST(regexp_extract(
                      p_name || ' $' || CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR),
                      '\$[\s]*([\d]+)', 1) AS INTEGER) AS price
             FROM part),
       pool AS (SELECT bs.b, l.city, l.link, l.price FROM l
                JOIN (SELECT unnest([0, 1, 2]) AS b) bs ON l.b0 <= bs.b
                WHERE l.price IS NOT NULL),
       best AS (SELECT b, city, link, min(price) AS price FROM pool GROUP BY b, city, link),
       top AS (SELECT * FROM (
                 SELECT b, city, link, price,
                        row_number() OVER (PARTITION BY b, city ORDER BY price, link) AS r
                 FROM best) WHERE r <= 5)
  SELECT CAST(t.b AS BIGINT) AS batch_id, t.city, t.link, t.price FROM top t
  LEFT JOIN top p ON p.b = t.b - 1 AND p.city = t.city AND p.link = t.link
                 AND p.price = t.price
  WHERE p.link IS NULL"""


@register("lowest_n_changes", _LISTING_BATCHES_SQL)
def lowest_n_changes(spark, sf_dir):
    """Lowest-5 price lists per city over three landed batches of listings;
    only entries that entered a list are reported, with their batch."""
    root, ckpt = _paths(spark, "lowest_n_changes")
    priced = (listings(spark, sf_dir)
              .withColumn("price", F.regexp_extract("title", TX.PRICE_PATTERN, 1)
                          .try_cast("int"))
              .where(F.col("price").isNotNull())
              .withColumn("batch", F.col("link").cast("bigint") % N_BATCHES)
              .select("city", "link", "price", "batch"))
    changes = _feed(spark, root)
    for stream in SS.landed_batches(priced, "batch", list(range(N_BATCHES)),
                                    os.path.join(root, "landing")):
        entered = SO.lowest_n(stream, "city", "link", "price", 5)
        SO.run_available(SO.feed_writer(entered, changes, ckpt))
    return changes.read().select("batch_id", "city", "link", "price")


# ------------------------------------------------------------ bus / triggers

@register("bus_source_replay", """
SELECT concat_ws(',', event_id, event_type, user_id) AS str FROM events""")
def bus_source_replay(spark, sf_dir):
    """Payload stream with stored progress: half of the payloads land, the
    query runs, the rest land, and the restarted query (same checkpoint)
    reads only the new files. Every payload is delivered exactly once."""
    root, ckpt = _paths(spark, "bus_source_replay")
    land, out = os.path.join(root, "landing"), os.path.join(root, "out")
    ev = table(spark, sf_dir, "events").select(
        F.concat_ws(",", "event_id", "event_type", "user_id").alias("value"),
        (F.col("event_id") % 2).alias("half"))
    for half in (0, 1):
        ev.where(F.col("half") == half).select("value").write.mode("append").text(
            os.path.join(land, f"part_{half}"))
        stream = SS.text_stream(spark, os.path.join(land, "part_*"), "str")
        SO.run_available(stream.writeStream.format("parquet").option("path", out)
                         .option("checkpointLocation", ckpt))
    return spark.read.parquet(out)


@register("tick_trigger", """
SELECT event_type, count(*) AS count FROM events GROUP BY event_type""")
def tick_trigger(spark, sf_dir):
    """Counts emitted on a processing-time tick (every second) until the
    input is drained."""
    root, ckpt = _paths(spark, "tick_trigger")
    ev = SS.table_stream(spark, sf_dir, "events")
    counts = ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("count"))
    out = _feed(spark, root)
    q = SO.feed_writer(counts, out, ckpt).trigger(processingTime="1 second").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return out.latest(["event_type"])


# ------------------------------------------------------------ keyed upsert

@register("keyed_upsert", """
SELECT o_custkey, o_orderstatus, arg_max(o_totalprice, o_orderkey) AS o_totalprice
FROM orders GROUP BY o_custkey, o_orderstatus""")
def keyed_upsert(spark, sf_dir):
    """Keyed upserts of order totals under (customer, status), three landed
    batches; per key the latest order (by orderkey) wins whatever the batch order."""
    root, ckpt = _paths(spark, "keyed_upsert")
    keys = ["o_custkey", "o_orderstatus"]
    orders = table(spark, sf_dir, "orders").select(
        *keys, "o_totalprice", "o_orderkey", (F.col("o_orderkey") % N_BATCHES).alias("batch"))
    out = _feed(spark, root)
    for stream in SS.landed_batches(orders, "batch", list(range(N_BATCHES)),
                                    os.path.join(root, "landing")):
        SO.run_available(SO.feed_writer(SO.latest_by(stream, keys, "o_orderkey"), out, ckpt))
    return out.latest(keys).select(*keys, "o_totalprice")


# ------------------------------------------------------------ more streams

@register("stream_rolling_count_zeros", """
WITH c AS (
  SELECT event_type, user_id, slot_start + to_hours(3 * (k + 1)) AS window_end,
         CAST(sum(n) AS BIGINT) AS count
  FROM (SELECT event_type, user_id,
               time_bucket(INTERVAL 3 HOUR, ts, TIMESTAMP '1970-01-01') AS slot_start,
               count(*) AS n FROM events GROUP BY ALL) s,
       (SELECT unnest([0, 1, 2]) AS k) ks
  GROUP BY ALL),
z AS (SELECT event_type, user_id, window_end + INTERVAL 3 HOUR AS window_end,
             CAST(0 AS BIGINT) AS count
      FROM (SELECT *, lead(window_end) OVER (PARTITION BY event_type, user_id
                                             ORDER BY window_end) AS nxt FROM c)
      WHERE nxt IS NULL OR nxt <> window_end + INTERVAL 3 HOUR)
SELECT event_type, user_id, window_end, count FROM c
UNION ALL SELECT event_type, user_id, window_end, count FROM z""")
def stream_rolling_count_zeros(spark, sf_dir):
    """Streaming window counts and, by the same event-time timers, the single zero
    row per object that leaves the window."""
    feed = _window_feed(spark, sf_dir, "stream_rolling_count_zeros", ["event_type", "user_id"])
    return feed.where("kind IN ('count', 'zero')").drop("kind")


@register("stream_xml_feed", """
SELECT CAST(event_id AS VARCHAR) AS id,
       CASE WHEN event_type = 'click' THEN NULL
            ELSE event_type || ' by user ' || CAST(user_id AS VARCHAR) END AS title,
       CASE WHEN event_type = 'purchase' THEN NULL
            ELSE 'http://feed.example/e/' || CAST(event_id AS VARCHAR) END AS href,
       coalesce(CASE WHEN event_type = 'click' THEN NULL
                     ELSE event_type || ' by user ' || CAST(user_id AS VARCHAR) END, 'null')
         || ' ---> ' ||
       coalesce(CASE WHEN event_type = 'purchase' THEN NULL
                     ELSE 'http://feed.example/e/' || CAST(event_id AS VARCHAR) END, '???')
         AS message
FROM events WHERE event_type <> 'error'""")
def stream_xml_feed(spark, sf_dir):
    """Landed feed files (an entry per line) as a stream; entries become log
    messages, malformed ones are dropped; landed by a file sink."""
    root, ckpt = _paths(spark, "stream_xml_feed")
    land, out = os.path.join(root, "landing"), os.path.join(root, "out")
    DV.xml_entries(spark, sf_dir).select(F.col("str").alias("value")).write.text(land)
    entries = SS.text_stream(spark, land, "str")
    msgs = DOC.xml_feed_events(entries)
    SO.run_available(msgs.writeStream.format("parquet").option("path", out)
                     .option("checkpointLocation", ckpt))
    return spark.read.parquet(out)


# ------------------------------------------------------------ proximity classifier

def _near_state(spark, sf_dir, name):
    """The classifier's state, kept by one stream: a message is scanned and flagged
    once, and both aggregates are one, over rows tagged as word or message. The
    quake summary is computed and stored once, before the stream."""
    root, ckpt = _paths(spark, name)
    summary = JN.stored_near_summary(DV.quakes(spark, sf_dir), "time", os.path.join(root, "quakes"))
    flagged = JN.flag_by_summary(_message_stream(spark, sf_dir), summary, "published")
    out = _feed(spark, root)
    SO.run_available(SO.feed_writer(BY.class_counts(flagged, "tweet"), out, ckpt, by="counted"))
    state = out.latest(["counted", "near", "word"])
    words = state.where("counted = 'word'").select("near", "word", F.col("count").alias("word_count"))
    totals = state.where("counted = 'message'").select("near", F.col("count").alias("message_count"))
    return root, words, totals


def _message_stream(spark, sf_dir):
    ev = SS.table_stream(spark, sf_dir, "events")
    return ev.where(~DV.is_quake()).select(
        "event_id", F.concat_ws(" ", "event_type", "props").alias("tweet"),
        RC.epoch_millis("ts").alias("published"))


@register("stream_near_word_counts", f"""
SELECT near, word, count(*) AS word_count
FROM (SELECT near, unnest({QK._JAVA_SPLIT}) AS word FROM ({QK._FLAGGED_SQL}))
GROUP BY near, word""")
def stream_near_word_counts(spark, sf_dir):
    """Words per class, from the flagged stream's one aggregate."""
    return _near_state(spark, sf_dir, "stream_near_word_counts")[1]


@register("stream_near_totals", f"""
SELECT near, count(*) AS message_count FROM ({QK._FLAGGED_SQL}) GROUP BY near""")
def stream_near_totals(spark, sf_dir):
    """Messages per class, from the same aggregate."""
    return _near_state(spark, sf_dir, "stream_near_totals")[2]


@register("stream_near_posterior", QK.POSTERIOR_SQL)
def stream_near_posterior(spark, sf_dir):
    """The classifier end to end on streams: one streaming aggregate keeps words and
    messages per class; a request stream (every message, which needs no flag) is
    then answered per micro-batch against the landed state."""
    root, words, totals = _near_state(spark, sf_dir, "stream_near_posterior")
    answers = _feed(spark, root, "answers")

    def answer(batch_df, batch_id):
        post = BY.posterior(batch_df, words, totals)
        answers.write(post.select("request_id", F.round("p_quake_given_tweet", 9)
                                  .alias("p_quake_given_tweet")), batch_id)

    requests = _message_stream(spark, sf_dir).select(
        F.col("event_id").alias("request_id"), F.col("tweet").alias("args"))
    SO.run_available(requests.writeStream.foreachBatch(answer)
                     .option("checkpointLocation", os.path.join(root, "ck_answers")))
    return answers.read().select("request_id", "p_quake_given_tweet")

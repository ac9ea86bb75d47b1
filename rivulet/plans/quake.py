"""The event-proximity classifier: quake events, messages flagged by their
proximity to a quake, per-class word statistics and the posterior
P(near | words) for every message."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.operators import bayes as BY
from rivulet.operators import joins as JN
from rivulet.plans.derived import messages, quakes
from rivulet.plans.registry import register
from rivulet.session import materialize

_FLAGGED_SQL = """
  WITH q AS (SELECT (epoch_us(ts) // 1000) AS t FROM events WHERE event_type = 'error' AND value > 150),
       m AS (SELECT event_id, concat_ws(' ', event_type, props) AS tweet,
                    (epoch_us(ts) // 1000) AS published
             FROM events WHERE NOT coalesce(event_type = 'error' AND value > 150, false))
  SELECT event_id, tweet, published,
         EXISTS (SELECT 1 FROM q WHERE abs(m.published - q.t) < 1800000) AS near
  FROM m"""

_JAVA_SPLIT = """CASE WHEN tweet <> '' AND rtrim(tweet, ' ') = '' THEN []::VARCHAR[]
                     ELSE string_split(rtrim(tweet, ' '), ' ') END"""


def flagged_messages(spark, sf_dir):
    """Messages with ``near``: a quake strictly within 30 minutes."""
    return JN.near_flag(messages(spark, sf_dir), quakes(spark, sf_dir),
                        "published", "time")


@register("near_flag", f"SELECT event_id, published, near FROM ({_FLAGGED_SQL})")
def near_flag(spark, sf_dir):
    return flagged_messages(spark, sf_dir).select("event_id", "published", "near")


@register("near_word_counts", f"""
SELECT near, word, count(*) AS word_count
FROM (SELECT near, unnest({_JAVA_SPLIT}) AS word FROM ({_FLAGGED_SQL}))
GROUP BY near, word""")
def near_word_counts(spark, sf_dir):
    return BY.class_word_counts(flagged_messages(spark, sf_dir), "tweet")


@register("near_totals", f"""
SELECT near, count(*) AS message_count FROM ({_FLAGGED_SQL}) GROUP BY near""")
def near_totals(spark, sf_dir):
    return BY.class_totals(flagged_messages(spark, sf_dir))


POSTERIOR_SQL = f"""
WITH f AS ({_FLAGGED_SQL}),
w AS (SELECT near, word, count(*) AS wc
      FROM (SELECT near, unnest({_JAVA_SPLIT}) AS word FROM f) GROUP BY near, word),
tot AS (SELECT coalesce(sum(CASE WHEN near THEN 1 END), 0) AS t1,
               coalesce(sum(CASE WHEN NOT near THEN 1 END), 0) AS t0 FROM f),
rates AS (SELECT word, sum(CASE WHEN near THEN wc ELSE 0 END) AS w1,
                 sum(CASE WHEN NOT near THEN wc ELSE 0 END) AS w0 FROM w GROUP BY word),
rw AS (SELECT DISTINCT request_id, word
       FROM (SELECT event_id AS request_id, unnest({_JAVA_SPLIT}) AS word FROM f)),
sc AS (SELECT request_id,
              product(CASE WHEN t1 = 0 THEN NULL ELSE CAST(w1 AS DOUBLE) / t1 END) AS prod1,
              product(CASE WHEN t0 = 0 THEN NULL ELSE CAST(w0 AS DOUBLE) / t0 END) AS prod0
       FROM rw JOIN rates USING (word) CROSS JOIN tot GROUP BY request_id),
s AS (SELECT f.event_id AS request_id,
             CAST(t1 AS DOUBLE) / (t1 + t0) AS prior,
             coalesce(prod1, 1.0) AS p1, coalesce(prod0, 1.0) AS p0
      FROM f CROSS JOIN tot LEFT JOIN sc ON sc.request_id = f.event_id)
SELECT request_id,
       round(CASE WHEN prior * p1 + (1 - prior) * p0 = 0 THEN NULL
                  ELSE prior * p1 / (prior * p1 + (1 - prior) * p0) END, 9)
         AS p_quake_given_tweet
FROM s"""


@register("near_posterior", POSTERIOR_SQL)
def near_posterior(spark, sf_dir):
    """Flagship: score every message with the naive-Bayes posterior that it
    was posted near a quake, from word statistics of all flagged messages."""
    # Three consumers (class totals, word counts, request words): flag once.
    flagged = materialize(flagged_messages(spark, sf_dir), "flagged_messages")
    wc = BY.class_word_counts(flagged, "tweet")
    tot = BY.class_totals(flagged)
    requests = flagged.select(F.col("event_id").alias("request_id"),
                              F.col("tweet").alias("args"))
    post = BY.posterior(requests, wc, tot)
    return post.select("request_id",
                       F.round("p_quake_given_tweet", 9).alias("p_quake_given_tweet"))

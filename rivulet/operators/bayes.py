"""Naive-Bayes posterior P(near | words) over flagged messages.

Training is two keyed counts over the flagged messages (tokens per
(class, word) and messages per class); scoring joins each request's words to
the per-word rates and sums their logs per request. Everything is a
partial-aggregated ``groupBy`` or an equi-join; the two class totals are
fetched by one small aggregation and enter the plan as literals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions.text import split_words
from rivulet.operators.aggregates import words


def class_word_counts(flagged: DataFrame, text: str, flag: str = "near",
                      mode: str = "java") -> DataFrame:
    """``(near, word, word_count)``: token counts per class."""
    return (words(flagged, text, mode, keep=(flag,))
            .groupBy(flag, "word").agg(F.count(F.lit(1)).alias("word_count")))


def class_totals(flagged: DataFrame, flag: str = "near") -> DataFrame:
    """``(near, message_count)``: messages per class."""
    return flagged.groupBy(flag).agg(F.count(F.lit(1)).alias("message_count"))


def class_counts(flagged: DataFrame, text: str, flag: str = "near",
                 mode: str = "java") -> DataFrame:
    """Both counts as one aggregate, ``(counted, near, word, count)``: every message
    becomes one ``message`` row (no word) and a ``word`` row per word."""
    tag = lambda kind, w: F.struct(F.lit(kind).alias("counted"), w.alias("word"))
    rows = F.concat(F.array(tag("message", F.lit(None).cast("string"))),
                    F.transform(F.coalesce(split_words(text, mode), F.array().cast("array<string>")),
                                lambda w: tag("word", w)))
    return (flagged.select(flag, F.inline(rows)).groupBy("counted", flag, "word")
            .agg(F.count(F.lit(1)).alias("count")))


def posterior(requests: DataFrame, word_counts: DataFrame, totals: DataFrame,
              request_id: str = "request_id", args: str = "args",
              flag: str = "near", mode: str = "java",
              name: str = "p_quake_given_tweet") -> DataFrame:
    """``(request_id, p)`` for every request.

    For each distinct word of a request that was seen in either class:
    ``p1 = W1/T1`` and ``p0 = W0/T0`` (a word missing from one class counts
    0 there). ``prior = T1/(T0+T1)`` and
    ``p = prior*prod(p1) / (prior*prod(p1) + (1-prior)*prod(p0))``, computed
    from sums of logs so that long requests keep their answer; a request with no known word gets the prior; 0/0 is NULL.
    """
    rates = (word_counts.groupBy("word").agg(
        F.sum(F.when(F.col(flag), F.col("word_count")).otherwise(0)).alias("w1"),
        F.sum(F.when(~F.col(flag), F.col("word_count")).otherwise(0)).alias("w0")))
    # Class totals are two numbers: one small aggregation job fetches them and
    # they enter the plan as literals (no join to a one-row table).
    tt = totals.agg(
        F.coalesce(F.sum(F.when(F.col(flag), F.col("message_count"))), F.lit(0)).alias("t1"),
        F.coalesce(F.sum(F.when(~F.col(flag), F.col("message_count"))), F.lit(0)).alias("t0"),
    ).first()
    t1, t0 = F.lit(int(tt["t1"])).cast("bigint"), F.lit(int(tt["t0"])).cast("bigint")

    req_words = requests.select(
        request_id, F.explode(F.array_distinct(split_words(args, mode))).alias("word"))
    scored = (req_words.join(rates, "word", "inner")
              .select(request_id,
                      F.try_divide(F.col("w1").cast("double"), t1).alias("p1"),
                      F.try_divide(F.col("w0").cast("double"), t0).alias("p0")))
    # Products of many rates underflow, so each class has the sum of its logs,
    # and a flag for a rate of zero.
    sums = scored.groupBy(request_id).agg(
        *[F.sum(F.when(F.col(c) > 0, F.ln(c))).alias(f"log_{c}") for c in ("p1", "p0")],
        *[F.max(F.col(c) == 0).alias(f"none_{c}") for c in ("p1", "p0")])
    out = requests.select(request_id).distinct().join(sums, request_id, "left")
    none1 = (t1 == 0) | F.coalesce("none_p1", F.lit(False))
    none0 = (t0 == 0) | F.coalesce("none_p0", F.lit(False))
    log1 = F.ln(t1.cast("double")) + F.coalesce("log_p1", F.lit(0.0))
    log0 = F.ln(t0.cast("double")) + F.coalesce("log_p0", F.lit(0.0))
    p = (F.when(none1 & none0, F.lit(None).cast("double")).when(none1, F.lit(0.0))
         .when(none0, F.lit(1.0)).otherwise(1 / (1 + F.exp(log0 - log1))))
    return out.select(request_id, p.alias(name))

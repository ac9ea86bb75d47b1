"""Reach: how many distinct people a key reaches through two lookups."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.session import materialize, shuffles_removed

# Followers, repeats included, that a request may have to be counted as one row.
LIGHT = 10_000
# (request, follower) pairs, repeats included, that are shuffled at a time. More requests are
# counted in rounds; a round has no fewer than twice the follower edges, as it reads them all.
ROUND = 250_000_000


class Links(NamedTuple):
    """What :func:`reach` looks up, stored: ``(request, tweeter)`` once each, the requests
    beyond the bound of ``light`` followers (None: there are none), the sets of followers
    of the tweeters within it, the follower edges, and the number of rounds."""

    reached_by: DataFrame
    heavy: DataFrame | None
    sets: DataFrame
    edges: DataFrame
    rounds: int


def _stored(df: DataFrame, name: str) -> DataFrame:
    with shuffles_removed(df.sparkSession):
        return materialize(df, name)


def reach_links(requests: DataFrame, tweeters: DataFrame, followers: DataFrame,
                request_id: str = "request_id", key: str = "url",
                tweeter: str = "tweeter", follower: str = "follower",
                light: int = LIGHT) -> Links:
    """The stored lookups of :func:`reach`, for several counts of the same requests."""
    edges = followers.select(tweeter, follower).where(F.col(follower).isNotNull())
    degrees = _stored(edges.groupBy(tweeter).agg(F.count(F.lit(1)).alias("_n")), "reach-degrees")
    reached_by = _stored(requests.select(request_id, key)
                         .join(tweeters.select(key, tweeter), key, "inner")
                         .select(request_id, tweeter).distinct(), "reach-links")
    weights = _stored(reached_by.join(degrees, tweeter).groupBy(request_id)
                      .agg(F.sum("_n").alias("_n")), "reach-weights")
    sets = _stored(edges.join(degrees.where(F.col("_n") > light), tweeter, "left_anti")
                   .groupBy(tweeter).agg(F.collect_set(follower).alias("_followers")), "reach-sets")
    pairs, most = weights.agg(F.coalesce(F.sum("_n"), F.lit(0)),
                              F.coalesce(F.max("_n"), F.lit(0))).first()
    known = degrees.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    heavy = weights.where(F.col("_n") > light).select(request_id) if most > light else None
    return Links(reached_by, heavy, sets, edges, max(1, -(-pairs // max(ROUND, 2 * known))))


def reach(requests: DataFrame, tweeters: DataFrame, followers: DataFrame,
          request_id: str = "request_id", key: str = "url",
          tweeter: str = "tweeter", follower: str = "follower",
          approx: bool = False, rsd: float = 0.05, light: int = LIGHT,
          links: Links | None = None) -> DataFrame:
    """``(request_id, reach)`` = distinct followers of everyone linked to the key.

    ``requests(request_id, key)``, ``tweeters(key, tweeter)`` and
    ``followers(tweeter, follower)`` are edge tables. Each (request, tweeter)
    pair is reduced to one row before the follower expansion. What a request
    expands to is counted first. Requests with at most ``light`` followers join
    the set of each of their tweeters and unite the sets, so that neither a set nor
    a union is larger; the others expand to (request, follower) rows, and the
    distinct count is Spark's two-phase distinct: partial dedupe on the map side,
    one exchange on the pair, then a count per request. An unknown key reaches 0.
    ``approx`` swaps in a HyperLogLog++ sketch of the same followers.

    Requests that expand to more than ``ROUND`` followers are counted in rounds, by a hash
    of the request; a round is stored and its shuffles are removed, so that disk follows
    the edge tables, not the expansion. ``links``: the stored lookups of the same tables
    (:func:`reach_links`), where reach is counted more than once.
    """
    if links is None:
        links = reach_links(requests, tweeters, followers, request_id, key, tweeter, follower, light)

    def counted(people: DataFrame) -> DataFrame:
        agg = F.approx_count_distinct(follower, rsd) if approx else F.count_distinct(follower)
        return people.groupBy(request_id).agg(agg.alias("reach"))

    def counts(reached_by: DataFrame) -> DataFrame:
        some = (reached_by if links.heavy is None
                else reached_by.join(links.heavy, request_id, "left_anti"))
        united = (some.join(links.sets, tweeter)
                  .select(request_id, "_followers").repartition(request_id).groupBy(request_id)
                  .agg(F.array_distinct(F.flatten(F.collect_list("_followers"))).alias("_followers")))
        out = (counted(united.select(request_id, F.explode("_followers").alias(follower))) if approx
               else united.select(request_id, F.size("_followers").cast("bigint").alias("reach")))
        return out if links.heavy is None else out.unionByName(counted(
            reached_by.join(links.heavy, request_id, "left_semi").join(links.edges, tweeter)))

    if links.rounds == 1:
        found = counts(links.reached_by)
    else:
        turn = F.pmod(F.xxhash64(request_id), F.lit(links.rounds))
        found = reduce(DataFrame.unionByName, [
            _stored(counts(links.reached_by.where(turn == k)), "reach-counts")
            for k in range(links.rounds)])
    return (requests.select(request_id).distinct()
            .join(found, request_id, "left")
            .select(request_id, F.coalesce("reach", F.lit(0)).cast("bigint").alias("reach")))

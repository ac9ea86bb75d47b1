"""One key holding a third of all rows: results stay whole and exact, and the
plans collapse the hot key before any exchange."""

import io
import os
import random
from collections import Counter
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from rivulet.operators import aggregates as AG
from rivulet.operators import joins as JN
from rivulet.operators import topk as TK
from rivulet.operators import reach as RE
from rivulet.operators.reach import reach
from rivulet.plans import derived as DV
from rivulet.sources import documents as DOC
from tests.conftest import rows


def _plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_hot_word_count(spark):
    rnd = random.Random(1)
    words = ["hot"] * 3000 + [f"w{rnd.randrange(500)}" for _ in range(6000)]
    rnd.shuffle(words)
    docs = [" ".join(words[i:i + 30]) for i in range(0, len(words), 30)]
    df = spark.createDataFrame([(d,) for d in docs], "text string").repartition(8)
    out = AG.word_count(df, "text")
    assert dict(rows(out)) == dict(Counter(words))
    p = _plan(out)
    # partial aggregate below the exchange: the hot word leaves each task as one row
    assert p.index("HashAggregate") < p.index("Exchange") < p.rindex("HashAggregate")


def test_hot_group_top_n(spark):
    data = [("hot", f"o{i}", i % 97) for i in range(3000)] + \
           [(f"g{i % 50}", f"o{i}", i % 13) for i in range(6000)]
    df = spark.createDataFrame(data, "g string, obj string, count long").repartition(8)
    got = rows(TK.top_by_count(df, "obj", 3, by=["g"]).where("g = 'hot'"), "rank", "obj", "count")
    hot = sorted([r for r in data if r[0] == "hot" and r[2] > 0], key=lambda r: (-r[2], r[1]))[:3]
    assert got == [(i + 1, r[1], r[2]) for i, r in enumerate(hot)]
    assert "WindowGroupLimit" in _plan(TK.top_by_count(df, "obj", 3, by=["g"]))


def test_hot_time_bucket_near_flag(spark):
    rnd = random.Random(3)
    W = 1_000
    events = [5_000 + rnd.randrange(W) for _ in range(600)] + \
             [rnd.randrange(0, 200_000) for _ in range(1200)]
    msgs = [5_000 + rnd.randrange(-W, 2 * W) for _ in range(500)] + \
           [rnd.randrange(0, 200_000) for _ in range(1000)]
    m = spark.createDataFrame(list(enumerate(msgs)), "id int, t long")
    e = spark.createDataFrame([(t,) for t in events], "t long")
    got = dict(rows(JN.near_flag(m, e, "t", "t", within_ms=W).select("id", "near")))
    ev_sorted = sorted(events)

    def near(t):
        import bisect
        i = bisect.bisect_left(ev_sorted, t)
        return any(abs(t - ev_sorted[j]) < W for j in (i - 1, i) if 0 <= j < len(ev_sorted))

    assert got == {i: near(t) for i, t in enumerate(msgs)}


@pytest.mark.parametrize("light", [0, 5, 40, 10_000])
def test_reach_of_light_and_heavy_requests(spark, light):
    """The same counts whichever requests are united as sets; links and follows come
    twice, some ends are null."""
    rnd = random.Random(7)
    links = [(f"u{rnd.randrange(30)}", rnd.choice(["star", None, *range(12)])) for _ in range(80)]
    links = [(u, t if t is None else str(t)) for u, t in links]
    follows = [("star", f) for f in range(60)] + [
        (str(rnd.randrange(12)), rnd.choice([None, *range(40)])) for _ in range(90)]
    req = spark.createDataFrame([(f"r{i}", f"u{i % 35}") for i in range(70)] + [(None, "u0"), ("r1", None)],
                                "request_id string, url string")
    tw = spark.createDataFrame(links + links[:20], "url string, tweeter string")
    fo = spark.createDataFrame(follows + follows[50:80], "tweeter string, follower int")
    want = {f"r{i}": len({f for u, t in links if u == f"u{i % 35}" and t is not None
                          for s, f in follows if s == t and f is not None}) for i in range(70)}
    got = reach(req, tw, fo, light=light)
    assert {r["request_id"]: r["reach"] for r in got.collect()} == want | {None: 0}
    about = reach(req, tw, fo, approx=True, rsd=0.01, light=light)
    assert all(abs(r["reach"] - (want | {None: 0})[r["request_id"]]) <= 2 for r in about.collect())


def test_reach_shuffles_sets_not_pairs(spark):
    """50 requests with the same 40 tweeters of 50 followers: 100,000 pairs, none of
    which is a row."""
    req = spark.range(50).selectExpr("id AS request_id", "id AS url")
    tw = spark.range(50 * 40).selectExpr("id % 50 AS url", "id DIV 50 AS tweeter")
    fo = spark.range(40 * 50).selectExpr("id % 40 AS tweeter", "id % 100 AS follower")
    df = reach(req, tw, fo)
    assert rows(df) == [(i, 100) for i in range(50)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "array_distinct(flatten(collect_list" in plan and "count(distinct" not in plan


@pytest.mark.parametrize("light", [0, 10_000])
def test_reach_in_rounds_keeps_no_shuffle(spark, monkeypatch, light):
    """100,000 pairs, at most 30,000 at a time: four rounds, each stored; what a
    round shuffled is gone when it ends."""
    monkeypatch.setattr(RE, "ROUND", 30_000)
    disk = spark._jsc.sc().env().blockManager().diskBlockManager()
    shuffled = lambda: sum(disk.getAllFiles().apply(i).getName().startswith("shuffle_")
                           for i in range(disk.getAllFiles().size()))
    req = spark.range(52).selectExpr("id AS request_id", "id AS url")
    tw = spark.range(50 * 40).selectExpr("id % 50 AS url", "id DIV 50 AS tweeter")
    fo = spark.range(40 * 50).selectExpr("id % 40 AS tweeter", "id % 100 AS follower")
    for approx in (False, True):
        before = shuffled()
        df = reach(req, tw, fo, approx=approx, rsd=0.01, light=light)
        assert shuffled() <= before + 20   # of the two sums; a round shuffles some ten times
        assert len({os.path.dirname(f) for f in df.inputFiles() if "reach-counts" in f}) == 4
        got = dict(rows(df))
        assert set(got) == set(range(52)) and got[50] == got[51] == 0
        assert all(abs(got[i] - 100) <= (2 if approx else 0) for i in range(50))


def test_hot_tweeter_reach(spark):
    rnd = random.Random(5)
    tweeters = [(f"u{r}", "star") for r in range(300)] + \
               [(f"u{rnd.randrange(300)}", f"t{rnd.randrange(100)}") for _ in range(300)]
    followers = [("star", f"f{i}") for i in range(2000)] + \
                [(f"t{rnd.randrange(100)}", f"f{rnd.randrange(3000)}") for _ in range(2000)]
    req = spark.createDataFrame([(u, u) for u in {a for a, _ in tweeters}],
                                "request_id string, url string")
    tw = spark.createDataFrame(tweeters, "url string, tweeter string")
    fo = spark.createDataFrame(followers, "tweeter string, follower string")
    got = dict(rows(reach(req, tw, fo)))
    fmap = {}
    for t, f in followers:
        fmap.setdefault(t, set()).add(f)
    want = {}
    for u, t in tweeters:
        want.setdefault(u, set()).update(fmap.get(t, set()))
    assert got == {u: len(s) for u, s in want.items()}


def test_hot_key_max_and_last_wins(spark):
    data = [("hot", i, float(i % 1000)) for i in range(3000)] + \
           [(f"k{i % 100}", i, float(i)) for i in range(6000)]
    df = spark.createDataFrame(data, "k string, seq long, v double").repartition(8)
    mx = dict(rows(AG.max_by_key(df, ["k"], "v", "m")))
    assert mx["hot"] == 999.0
    last = dict(rows(df.groupBy("k").agg(F.max_by("v", "seq").alias("v"))))
    assert last["hot"] == float(2999 % 1000)


def test_hot_users_feed_is_cut_into_documents(spark, tmp_dir):
    (spark.range(9000).select(
        F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("ts"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).cast("bigint")
        .alias("user_id"),
        F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit("p").alias("props"))
     .write.parquet(f"{tmp_dir}/events.parquet"))
    docs = DV.xml_feed_docs(spark, tmp_dir, page=100)
    entries = [r["str"].count("<entry>") for r in docs.collect()]
    assert sum(entries) == 9000 and max(entries) < 200
    got = DOC.xml_feed_documents(docs).groupBy("refresh_url").agg(
        F.count("id").alias("n"), F.countDistinct("id").alias("ids")).collect()
    last = {7 if k % 3 == 0 else k % 500: k for k in range(9000)}
    assert {r["refresh_url"] for r in got} == {
        f"http://feed.example/after/{k}" for k in last.values()}
    assert sum(r["n"] for r in got) == sum(r["ids"] for r in got) == 9000

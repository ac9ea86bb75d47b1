"""Small invented inputs; expected values by hand or by plain Python."""

import json
import os
import random

from pyspark.sql import functions as F

from rivulet.operators import aggregates as AG
from rivulet.operators import joins as JN
from rivulet.operators import topk as TK
from rivulet.operators import windows as WN
from rivulet.operators.reach import reach
from rivulet.sources import documents as DOC
from rivulet.sources import files as FS
from tests.conftest import rows

# An invented graph: pages shared by accounts, accounts read by people.
_R = random.Random(11)
TWEETERS = {f"page-{p}": _R.sample(range(20), 2 + 3 * p) for p in range(4)}
FOLLOWERS = {t: _R.sample(range(100, 140), _R.randrange(9)) for t in range(0, 20, 2)}
# (batch, word): three batches of invented words.
BATCHED = [(b, w) for b, ws in enumerate((["pear"] * 6 + ["plum", "lime"], ["pear"] * 5 + ["plum"],
                                          ["lime"] * 11)) for w in ws]


def _edges(spark, m, a, b):
    return spark.createDataFrame([(k, v) for k, vs in m.items() for v in vs],
                                 f"{a} {'string' if a == 'url' else 'long'}, {b} long")


def test_reach_counts_distinct_followers(spark):
    urls = [*TWEETERS, "page-unknown"]
    want = {i: len({f for t in TWEETERS.get(u, ()) for f in FOLLOWERS.get(t, ())})
            for i, u in enumerate(urls)}
    assert max(want.values()) > 10
    req = spark.createDataFrame(list(enumerate(urls)), "request_id int, url string")
    edges = (_edges(spark, TWEETERS, "url", "tweeter"), _edges(spark, FOLLOWERS, "tweeter",
                                                             "follower"))
    assert dict(rows(reach(req, *edges))) == want
    twice = edges[0].unionByName(edges[0])  # repeated edges change nothing
    assert dict(rows(reach(req, twice, edges[1]))) == want
    about = dict(rows(reach(req, *edges, approx=True)))
    assert all(abs(about[i] - n) <= 0.2 * n for i, n in want.items())


def _batched_words(spark):
    return spark.createDataFrame(BATCHED, "batch_id int, word string")


def test_global_count_per_batch(spark):
    df = _batched_words(spark)
    per = dict(rows(df.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))))
    assert per == {b: sum(x == b for x, _ in BATCHED) for b in range(3)}
    assert AG.global_count(df).first()["count"] == len(BATCHED)


def test_word_totals_and_histogram(spark):
    df = _batched_words(spark)
    counts = df.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    total = {w: sum(x == w for _, x in BATCHED) for _, w in BATCHED}
    assert dict(rows(counts)) == total
    buckets = [n // 10 for n in total.values()]
    assert rows(AG.count_histogram(counts)) == sorted((b, buckets.count(b)) for b in set(buckets))
    seen, feed, held, deltas = {}, [], {}, []
    for b in range(3):
        moved = set()
        for w in sorted({x for y, x in BATCHED if y == b}):
            old = seen.get(w)
            seen[w] = (old or 0) + sum(x == (b, w) for x in BATCHED)
            feed.append((w, b, seen[w], old))
            if old is None or old // 10 != seen[w] // 10:
                moved.add(seen[w] // 10)
                held[seen[w] // 10] = held.get(seen[w] // 10, 0) + 1
                if old is not None:
                    moved.add(old // 10)
                    held[old // 10] -= 1
        deltas += [(b, k, held[k]) for k in moved]
    upd = AG.count_with_prev(df, "word", "batch_id")
    assert sorted(rows(upd.select("word", "batch_id", "count", "prev_count")), key=str) == sorted(
        feed, key=str)
    assert rows(AG.histogram_deltas(upd)) == sorted(deltas)


def test_histogram_deltas_move_between_buckets(spark):
    data = [("k", 0)] * 9 + [("k", 1)] * 2 + [("j", 1)]
    df = spark.createDataFrame(data, "key string, batch_id int")
    upd = AG.count_with_prev(df, "key", "batch_id")
    got = rows(AG.histogram_deltas(upd))
    # batch 0: k enters bucket 0; batch 1: k moves 0 -> 1 (bucket 0 keeps j), j enters 0
    assert got == [(0, 0, 1), (1, 0, 1), (1, 1, 1)]


def test_natural_join_of_two_tables(spark):
    colour = {k: ("red", "blue", "grey")[k % 3] for k in range(4, 13)}
    weight = {k: 7 * k % 5 for k in range(12, 3, -1)}
    out = JN.natural_join([spark.createDataFrame(list(colour.items()), "item int, colour string"),
                           spark.createDataFrame(list(weight.items()), "item int, weight int")],
                          ["item", "colour", "weight"], strict=True)
    assert rows(out) == [(k, colour[k], weight[k]) for k in sorted(colour)]


def test_natural_join_errors(spark):
    import pytest

    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(1, "y")], "id int, b string")
    with pytest.raises(ValueError):
        JN.natural_join([a, b], ["id", "nope"])
    dup = spark.createDataFrame([(1, "y"), (1, "z")], "id int, b string")
    with pytest.raises(Exception):
        JN.natural_join([a, dup], ["id", "a", "b"], strict=True).collect()


def test_sliding_window_golden(spark):
    # one event in each of the first four slots, five slots of 60 s
    df = spark.createDataFrame([("o", f"2024-01-01 00:0{i}:30") for i in range(4)],
                               "obj string, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    counts = WN.rolling_count(df, "ts", ["obj"], 300, 60)
    seq = [r["count"] for r in counts.orderBy("window_end").collect()]
    assert seq == [1, 2, 3, 4, 4, 3, 2, 1]
    z = WN.with_zero_rows(counts, ["obj"], 60).orderBy("window_end").collect()
    assert [r["count"] for r in z] == [1, 2, 3, 4, 4, 3, 2, 1, 0]
    lengths = WN.with_window_length(counts, df, "ts", 300, 60).orderBy("window_end")
    assert [r["window_length_seconds"] for r in lengths.collect()] == [60, 120, 180, 240, 300, 300, 300, 300]
    assert WN.window_geometry(90, 60) == (2, 120)   # fewer than 2 slots not allowed


def test_rolling_top_n_ties(spark):
    df = spark.createDataFrame([("w", "b", 2), ("w", "a", 2), ("w", "c", 1), ("w", "z", 0)],
                               "win string, obj string, count long")
    got = [(r["obj"], r["rank"]) for r in TK.top_by_count(df, "obj", 5, by=["win"]).orderBy("rank").collect()]
    assert got == [("a", 1), ("b", 2), ("c", 3)]    # zero counts excluded


def test_lowest_n_per_group(spark):
    data = [("c", "l1", 5, "t1"), ("c", "l2", 3, "t2"), ("c", "l1", 2, "t1b"),
            ("c", "l3", 3, "t3"), ("d", "l9", 1, "t9")]
    df = spark.createDataFrame(data, "city string, link string, price int, title string")
    got = rows(TK.lowest_n_per_group(df, "city", "link", "price", 2, carry=["title"]),
               "city", "rank", "link", "price", "title")
    assert got == [("c", 1, "l1", 2, "t1b"), ("c", 2, "l2", 3, "t2"), ("d", 1, "l9", 1, "t9")]


def test_lookup_loader_last_wins(spark, tmp_dir):
    lines = ["boston\t http://b1", "nyc\thttp://n1", "boston\thttp://b2",
             "", "sf\t http://s1", 'la\thttp://l1"', "nyc\t http://n2",
             "novalue", "extra\thttp://e1\tignored"]
    p = os.path.join(tmp_dir, "feeds.txt")
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    got = dict(rows(FS.load_lookup(spark, p)))
    assert got == {"boston": "http://b2", "nyc": "http://n2", "sf": "http://s1",
                   "la": 'http://l1"', "extra": "http://e1"}


def test_csv_scan_names(spark, tmp_dir):
    p = os.path.join(tmp_dir, "a.csv")
    with open(p, "w") as f:
        f.write('x;y\n1;"q;uoted"\n2;b\n')
    hdr = FS.csv_scan(spark, p, sep=";", header=True)
    assert hdr.columns == ["x", "y"] and rows(hdr) == [("1", "q;uoted"), ("2", "b")]
    nohdr = FS.csv_scan(spark, p, sep=";")
    assert nohdr.columns == ["field_0", "field_1"] and nohdr.count() == 3


def _feature(magnitude, name):
    # The member names of the feed's features.
    return {"type": "Feature", "id": name, "geometry": {"type": "Point", "coordinates": [1, 2, 3]},
            "properties": {"mag": magnitude, "place": f"near {name}", "time": 1_700_000_000_000}}


def test_geojson_file(spark, tmp_dir):
    p = os.path.join(tmp_dir, "invented.geojson")
    doc = {"type": "FeatureCollection",
           "features": [_feature(2.0, "x1"), _feature(4.5, "x2"), _feature(None, "x3")]}
    with open(p, "w") as f:
        json.dump(doc, f, indent=2)
    every = [r["mag"] for r in DOC.read_geojson(spark, p, min_magnitude=None).collect()]
    assert 2.0 in every and 4.5 in every
    assert [r["mag"] for r in DOC.read_geojson(spark, p).collect()] == [4.5]  # above 2.5
    df = spark.createDataFrame([(json.dumps(doc),)], "json string")
    assert DOC.geojson_features(df).count() == 1           # a null magnitude is dropped


def test_near_flag_bound(spark):
    quake = 10_000_000
    msgs = [(1, quake + 1_800_000), (2, quake + 1_799_999), (3, quake - 1_800_000),
            (4, quake - 1_799_999), (5, quake), (6, None)]
    m = spark.createDataFrame(msgs, "id int, t long")
    e = spark.createDataFrame([(quake,)], "t long")
    got = dict(rows(JN.near_flag(m, e, "t", "t").select("id", "near")))
    assert got == {1: False, 2: True, 3: False, 4: True, 5: True, 6: False}


def test_near_flag_brute_force(spark):
    rnd = random.Random(7)
    W = 1_000
    ev = [rnd.randrange(0, 50_000) for _ in range(40)] + [-2_500, -1]
    ms = [rnd.randrange(-3_000, 53_000) for _ in range(400)]
    m = spark.createDataFrame(list(enumerate(ms)), "id int, t long")
    e = spark.createDataFrame([(t,) for t in ev], "t long")
    got = dict(rows(JN.near_flag(m, e, "t", "t", within_ms=W).select("id", "near")))
    want = {i: any(abs(t - q) < W for q in ev) for i, t in enumerate(ms)}
    assert got == want


def test_time_bounded_join(spark):
    import datetime as dt

    base = dt.datetime(2024, 1, 1)
    left = spark.createDataFrame([(1, base), (2, base)], "k int, lt timestamp_ntz")
    right = spark.createDataFrame([(1, base + dt.timedelta(seconds=60)),
                                   (2, base + dt.timedelta(seconds=61))], "k int, rt timestamp_ntz")
    out = JN.time_bounded_join(left, right, ["k"], "lt", "rt", 60)
    assert [r[0] for r in out.select("l.k").collect()] == [1]
    outer = JN.time_bounded_join(left, right, ["k"], "lt", "rt", 60, how="left_outer")
    assert outer.count() == 2


def test_max_by_key_nan_wins(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", float("nan")), ("y", -5.0)], "k string, v double")
    got = {r["k"]: r["m"] for r in AG.max_by_key(df, ["k"], "v", "m").collect()}
    assert got["y"] == -5.0 and got["x"] != got["x"]      # NaN is the maximum


def test_first_n_direction_and_global_top(spark):
    df = spark.createDataFrame([("p", "b"), ("p", "a"), ("p", "c"), ("q", "z")], "g string, w string")
    asc = rows(TK.first_n_per_partition(df, "g", "w", 2), "g", "w", "rank")
    desc = rows(TK.first_n_per_partition(df, "g", "w", 1, ascending=False), "g", "w")
    assert asc == [("p", "a", 1), ("p", "b", 2), ("q", "z", 1)]
    assert desc == [("p", "c"), ("q", "z")]
    top = TK.top_n(df, 2, ["w"]).orderBy("rank").collect()
    assert [(r["w"], r["rank"]) for r in top] == [("a", 1), ("b", 2)]

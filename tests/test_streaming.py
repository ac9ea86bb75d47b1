"""Streaming = batch, exactly-once over faults and restarts, bounded state."""

import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import StreamingQueryException

from rivulet.operators import aggregates as AG
from rivulet.operators import joins as JN
from rivulet.operators import topk as TK
from rivulet.operators import windows as WN
from rivulet.plans import derived as DV
from rivulet.session import keyed_state_store
from rivulet.sinks.tables import BatchLog
from rivulet.streaming import operators as SO
from rivulet.streaming import sources as SS
from rivulet.streaming import state as ST
from tests.conftest import rows

# Words that land together, batch by batch.
BATCHES = [["fig", "oak", "oak"], [], ["oak", "elm", "fig", "fig", "fig"], ["ash"]]
DAY = 86_400


@pytest.fixture(autouse=True)
def three_partitions(spark):
    """Few state partitions: the jobs are small and restarted often."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


class LosesACommit(BatchLog):
    """A feed whose writer dies once, after batch ``at`` is written and before Spark
    can commit it: the restarted query must run that batch again."""

    def __init__(self, spark, path, at):
        super().__init__(spark, path)
        self.at, self.written = at, []

    def write(self, rows_, batch_id, by=None):
        super().write(rows_, batch_id, by)
        self.written.append(batch_id)
        if batch_id == self.at and self.written.count(batch_id) == 1:
            raise RuntimeError("executor lost")


def _run(start, feed, ck):
    try:
        SO.run_available(SO.feed_writer(start, feed, ck))
    except StreamingQueryException as e:
        assert "executor lost" in str(e)
        SO.run_available(SO.feed_writer(start, feed, ck))


def _land(spark, root, job, batches=BATCHES, schema="word string", lost=None):
    """Runs ``job(stream)`` on every landed batch; returns the feed."""
    rows_in = [(i, *(w if isinstance(w, tuple) else (w,))) for i, ws in enumerate(batches) for w in ws]
    df = spark.createDataFrame(rows_in, f"batch int, {schema}").repartition(5)
    feed = LosesACommit(spark, os.path.join(root, "feed"), lost)
    for stream in SS.landed_batches(df, "batch", list(range(len(batches))),
                                    os.path.join(root, "landing")):
        _run(job(stream), feed, os.path.join(root, "ck"))
    if lost is not None:
        assert feed.written.count(lost) == 2  # the fault did happen
    return feed


def _running(batches):
    """(batch, total) and (batch, word, count, previous) by plain Python."""
    total, seen, totals, updates = 0, {}, [], []
    for i, ws in enumerate(batches):
        total += len(ws)
        totals.append((i, total))
        for w in sorted(set(ws)):
            old = seen.get(w)
            seen[w] = (old or 0) + ws.count(w)
            updates.append((i, w, seen[w], old))
    return totals, updates, seen


# ------------------------------------------------------------ totals, counts, upserts

@pytest.mark.parametrize("lost", [None, 2])
def test_running_total_exactly_once(spark, tmp_dir, lost):
    feed = _land(spark, tmp_dir, SO.running_total, lost=lost)
    assert rows(feed.read(), "batch_id", "count") == _running(BATCHES)[0]


def test_running_total_with_fewer_rows_than_files(spark, tmp_dir):
    """Seven rows in eight-way batches: a landed batch is a micro-batch."""
    feed = _land(spark, tmp_dir, SO.running_total, [["a"] * 2, ["b"] * 3, ["c"] * 2])
    assert rows(feed.read(), "batch_id", "count") == [(0, 2), (1, 5), (2, 7)]


@pytest.mark.parametrize("lost", [None, 2])
def test_keyed_counts_with_previous_value(spark, tmp_dir, lost):
    feed = _land(spark, tmp_dir, lambda s: SO.keyed_counts(s, ["word"]), lost=lost)
    _, updates, seen = _running(BATCHES)
    got = rows(feed.read(), "batch_id", "word", "count", "prev_count")
    assert sorted(got, key=str) == sorted(updates, key=str)
    assert dict(rows(feed.latest(["word"]), "word", "count")) == seen


def test_a_batch_writes_what_it_changed(spark, tmp_dir):
    many = [f"w{k}" for k in range(300)]
    feed = _land(spark, tmp_dir, lambda s: SO.keyed_counts(s, ["word"]), [many, ["w5"], ["new", "w5"]])
    assert rows(feed.read().groupBy("batch_id").count()) == [(0, 300), (1, 1), (2, 2)]


def test_null_keys_are_counted(spark, tmp_dir):
    feed = _land(spark, tmp_dir, lambda s: SO.keyed_counts(s, ["word"]), [["a", None], [None, None]])
    got = sorted([(r["batch_id"], r["word"], r["count"]) for r in feed.read().collect()], key=str)
    assert got == sorted([(0, "a", 1), (0, None, 1), (1, None, 3)], key=str)


@pytest.mark.parametrize("lost", [None, 1])
def test_upserts_keep_the_latest_whatever_the_order(spark, tmp_dir, lost):
    batches = [[("a", 5, "new"), ("b", 1, "x")], [("a", 3, "old"), ("b", 2, "y")], [("c", 9, "z")]]
    feed = _land(spark, tmp_dir, lambda s: SO.latest_by(s, ["k"], "v"), batches,
                 "k string, v long, s string", lost)
    assert rows(feed.latest(["k"]), "k", "v", "s") == [("a", 5, "new"), ("b", 2, "y"), ("c", 9, "z")]
    assert feed.read().where("batch_id = 2").count() == 1


PROVIDER = "spark.sql.streaming.stateStore.providerClass"
STORES = "org.apache.spark.sql.execution.streaming.state."


@pytest.fixture()
def plain(spark):
    """A session with Spark's own state store, as a launcher makes it."""
    s = spark.newSession()
    s.conf.set(PROVIDER, STORES + "HDFSBackedStateStoreProvider")
    s.conf.set("spark.sql.shuffle.partitions", "2")
    return s


@pytest.mark.parametrize("job, batches, schema, expected", [
    (lambda s: SO.top_n(SO.keyed_counts(s, ["word"]), "word", 2), [["fig", "oak", "oak"]],
     "word string", [(1, "oak", 2), (2, "fig", 1)]),
    (lambda s: SO.histogram(SO.keyed_counts(s, ["word"]), 5), [["fig", "oak", "oak"]],
     "word string", [(0, 2)]),
    (lambda s: SO.keyed_counts(s, ["word"]).drop("prev_count"), [["fig", "oak"], ["oak"]],
     "word string", [("fig", 1), ("oak", 1), ("oak", 2)]),
    (lambda s: SO.keyed_fold(s, ["k"], "total bigint", lambda old, row: ((old or (0,))[0] + row.v,)),
     [[("a", 1), ("a", 2)]], "k string, v long", [("a", 3)]),
    (lambda s: SO.lowest_n(s, "city", "link", "price", 1), [[("a", "x", 3), ("a", "y", 2)]],
     "city string, link string, price int", [("a", 2, "y")]),
    (lambda s: SO.window_counts(s.withColumn("ts", F.timestamp_seconds("at")), "ts", ["word"], 7200,
                                3600, "1 hour", True), [[("a", 0)]],
     "word string, at long", [("update", "a", 3_600_000, 1), ("update", "a", 7_200_000, 1)]),
    (lambda s: SO.natural_join([s.where("a > 0").select("k", "a"), s.where("b > 0").select("k", "b")],
                               ["k", "a", "b"]), [[(1, 5, 0), (1, 0, 7), (2, 5, 0)]],
     "k long, a int, b int", [("joined", 3, 1, 5, 7)]),
])
def test_keyed_state_needs_no_setting(plain, tmp_dir, job, batches, schema, expected):
    """Every operator with state of its own runs where the session chose no store."""
    feed = _land(plain, tmp_dir, job, batches, schema)
    assert rows(feed.read().drop("batch_id")) == expected


def test_a_chosen_state_store_stays(plain):
    plain.conf.set(PROVIDER, "com.example.OwnStateStoreProvider")
    keyed_state_store(plain)
    assert plain.conf.get(PROVIDER) == "com.example.OwnStateStoreProvider"


def test_keyed_fold_is_the_callers_state(spark, tmp_dir):
    def step(old, row):
        low, high = old or (row.v, row.v)
        return min(low, row.v), max(high, row.v)

    feed = _land(spark, tmp_dir, lambda s: SO.keyed_fold(s, ["k"], "low bigint, high bigint", step),
                 [[("a", 5), ("a", 2), ("b", 1)], [("a", 3)], [("a", 9), ("b", 1)]], "k string, v long")
    assert rows(feed.read(), "batch_id", "k", "low", "high") == [
        (0, "a", 2, 5), (0, "b", 1, 1), (2, "a", 2, 9)]  # unchanged keys are not emitted


@pytest.mark.parametrize("lost", [None, 1])
def test_histogram_by_deltas(spark, tmp_dir, lost):
    rng = random.Random(4)
    batches = [[f"k{rng.randrange(12)}" for _ in range(60)] for _ in range(3)]
    feed = _land(spark, tmp_dir, lambda s: SO.histogram(SO.keyed_counts(s, ["word"]), 5), batches,
                 lost=lost)
    flat = spark.createDataFrame([(w, b) for b, ws in enumerate(batches) for w in ws],
                                 "word string, batch_id int")
    want = AG.histogram_deltas(AG.count_with_prev(flat, "word"), size=5)
    assert rows(feed.read(), "batch_id", "bucket", "n_keys") == rows(want, "batch_id", "bucket", "n_keys")
    final = dict(rows(feed.latest(["bucket"])))
    counts = Counter(w for ws in batches for w in ws)
    alive = Counter(c // 5 for c in counts.values())
    assert {b: n for b, n in final.items() if n} == dict(alive)
    assert 0 in final.values()  # emptied buckets stay


# ------------------------------------------------------------ lowest-N

@pytest.mark.parametrize("lost", [None, 1])
def test_lowest_n_change_feed(spark, tmp_dir, lost):
    batches = [[("c", "l1", 5), ("c", "l2", 7), ("c", "l1", 6)],
               [("c", "l3", 1), ("c", "l4", 9), ("c", "l1", 8)],   # l2 is pushed out
               [("c", "l5", 6)],                                   # nothing changes
               [("c", "l2", 0), ("d", "l1", 4), ("c", None, 1)]]   # l2 comes back, lower
    feed = _land(spark, tmp_dir, lambda s: SO.lowest_n(s, "city", "link", "price", 2), batches,
                 "city string, link string, price int", lost)
    got = sorted([(r["batch_id"], r["city"], r["link"], r["price"]) for r in feed.read().collect()],
                 key=str)
    assert got == sorted([(0, "c", "l1", 5), (0, "c", "l2", 7), (1, "c", "l3", 1), (3, "c", "l2", 0),
                          (3, "d", "l1", 4), (3, "c", None, 1)], key=str)


def test_lowest_n_matches_batch_on_random_listings(spark, tmp_dir):
    rng = random.Random(9)
    batches = [[(f"c{rng.randrange(3)}", f"l{rng.randrange(25):02d}", rng.randrange(40), rng.randrange(5))
                for _ in range(50)] for _ in range(3)]
    feed = _land(spark, tmp_dir, lambda s: SO.lowest_n(s, "city", "link", "price", 4, ["size"]), batches,
                 "city string, link string, price int, size int")
    held = defaultdict(dict)
    want, before = [], {}
    for b, ws in enumerate(batches):
        for city, link, price, size in ws:
            best = held[city].get(link)
            if best is None or (price, size) < best:
                held[city][link] = (price, size)
        for city, links in held.items():
            low = sorted((p, link, s) for link, (p, s) in links.items())[:4]
            entered = {(p, link) for p, link, _ in low} - {(p, link) for p, link, _ in before.get(city, ())}
            want += [(b, city, link, p, s) for p, link, s in low if (p, link) in entered]
            before[city] = low
    assert rows(feed.read(), "batch_id", "city", "link", "price", "size") == sorted(want)


# ------------------------------------------------------------ windows

def _clicks(spark, n=400, seed=3, keys="abc", days=3):
    rng = random.Random(seed)
    data = [(k, rng.choice(keys), rng.randrange(days * DAY)) for k in range(n)]
    # Two quiet days in between, so that windows empty and fill again.
    data = [(k, u, s if s < DAY else s + 2 * DAY) for k, u, s in data]
    return spark.createDataFrame(data, "id int, user string, s long").select(
        "id", "user", F.timestamp_add("SECOND", F.col("s"), F.lit("2024-02-01").cast("timestamp_ntz"))
        .alias("ts"))


def _windows(spark, root, df, job, lost=None):
    """``job(stream, delay)`` over four batches in order of arrival and a heartbeat."""
    landed, delay = DV.in_arrival_order(df, "ts", "id", 4, 5 * 3600)
    feed = LosesACommit(spark, os.path.join(root, "feed"), lost)
    queries = []
    for stream in SS.landed_batches(landed, "batch", [0, 1, 2, 3, 4], os.path.join(root, "in")):
        for _ in range(2):
            try:
                queries.append(SO.run_available(SO.feed_writer(
                    job(stream, delay), feed, os.path.join(root, "ck"))))
                break
            except StreamingQueryException as e:
                assert "executor lost" in str(e)
    return feed, queries


def _state_rows(query):
    return [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in query.recentProgress
            if p["stateOperators"]]


@pytest.mark.parametrize("lost", [None, 3])
def test_zero_rows_come_from_timers(spark, tmp_dir, lost):
    df = _clicks(spark)
    batch = WN.with_zero_rows(WN.rolling_count(df, "ts", ["user"], 7200 * 3, 7200), ["user"], 7200)
    feed, queries = _windows(spark, tmp_dir, df, lambda s, delay: SO.window_counts(
        s, "ts", ["user"], 7200 * 3, 7200, delay, weight="weight"), lost)
    got = feed.read().select("user", SO.wall_clock("end_ms").alias("window_end"), "count", "kind")
    assert rows(got.drop("kind")) == rows(batch)   # each (user, tick) once
    assert rows(got.where("count = 0").select("kind").distinct()) == [("zero",)]
    assert feed.read().where("kind = 'late'").count() == 0
    assert feed.read().select("batch_id").distinct().count() >= 3   # emitted as the time moved on
    assert _state_rows(queries[-1])[-1] == 0       # and nothing is kept behind the last window


def test_state_is_bounded_by_the_open_windows(spark, tmp_dir):
    df = _clicks(spark, 600, keys="abcdefghij", days=6)
    _, queries = _windows(spark, tmp_dir, df, lambda s, delay: SO.window_counts(
        s, "ts", ["user"], 7200, 3600, "8 hours", weight="weight"))
    assert max(x for q in queries for x in _state_rows(q)) <= 20  # a value and a timer per user


def test_keys_share_values_of_the_state(spark, tmp_dir, monkeypatch):
    """A state key costs a micro-batch calls and an Arrow batch: keys must not."""
    monkeypatch.setattr(SO, "BUCKETS", 8)
    df = _clicks(spark, 900, keys=[f"u{k}" for k in range(200)] + [None])
    batch = WN.with_zero_rows(WN.rolling_count(df, "ts", ["user"], 7200 * 3, 7200), ["user"], 7200)
    feed, queries = _windows(spark, tmp_dir, df, lambda s, delay: SO.window_counts(
        s, "ts", ["user"], 7200 * 3, 7200, delay, weight="weight"), 2)
    got = feed.read().select("user", SO.wall_clock("end_ms").alias("window_end"), "count")
    assert sorted(got.collect(), key=str) == sorted(batch.select(*got.columns).collect(), key=str)
    held = [x for q in queries for x in _state_rows(q)]
    assert 0 < max(held) <= 16 and held[-1] == 0   # a value and a timer per bucket


def test_counts_of_many_keys_share_values_of_the_state(spark, tmp_dir, monkeypatch):
    """1,100 words in 4 buckets, whose pages double as words come; a key of the state for
    each word cost a micro-batch calls and an Arrow batch."""
    monkeypatch.setattr(SO, "BUCKETS", 4)
    rng = random.Random(3)
    batches = [[f"w{rng.randrange(k)}" for _ in range(900)] + [None] * k for k in (200, 1500)]
    df = spark.createDataFrame([(i, w) for i, ws in enumerate(batches) for w in ws],
                               "batch int, word string").repartition(3)
    feed, held = BatchLog(spark, os.path.join(tmp_dir, "feed")), []
    for s in SS.landed_batches(df, "batch", [0, 1], os.path.join(tmp_dir, "in")):
        q = SO.run_available(SO.feed_writer(SO.keyed_counts(s, ["word"]), feed,
                                            os.path.join(tmp_dir, "ck")))
        held.append(max(_state_rows(q)))
    got = [(r["batch_id"], r["word"], r["count"], r["prev_count"]) for r in feed.read().collect()]
    counts = [Counter(ws) for ws in batches]
    assert sorted(got, key=str) == sorted(
        [(0, w, n, None) for w, n in counts[0].items()]
        + [(1, w, n + counts[0][w], counts[0].get(w)) for w, n in counts[1].items()], key=str)
    assert 0 < held[0] <= 4 * 2 and held[1] <= 4 * 5   # a size per bucket, and its pages


def test_pages_of_counts_are_read_for_their_keys_only():
    """A page is read and written by a micro-batch that has one of its keys."""
    class Held(dict):
        calls = 0
        exists = lambda self: 0 in self
        get = lambda self: self[0]
        update = lambda self, v: self.update_(0, v)
        containsKey = dict.__contains__  # noqa: N815
        getValue = dict.__getitem__  # noqa: N815

        def update_(self, k, v):
            self.calls += 1
            self[k] = v

        updateValue = update_  # noqa: N815

    size, pages = Held(), Held()
    counts = ST.KeyedCounts(["word"], 1)
    counts.page = 8
    counts.size, counts.counts = size, pages
    row = lambda words: {"word": words, "_hash": [abs(w) for w in words], "n": [1] * len(words)}
    list(counts.handleInputRows((0,), iter([row([*range(100)]), row([*range(50)])]), None))
    assert size[0] == (16, 100) and len(pages) == 16
    pages.calls = 0
    out = list(counts.handleInputRows((0,), iter([row([3, 3, 100])]), None))
    assert sorted((w, c, p) for r in out for w, c, p in zip(r.word, r["count"], r.prev_count)) == [
        (3, 4, 2), (100, 1, None)]
    assert pages.calls == 2 and size[0] == (16, 101)


def test_a_task_sends_few_rows_to_the_rankings(spark):
    df = spark.range(0, 3000, numPartitions=1).selectExpr("id % 4 AS _bucket", "id % 1000 AS obj", "id AS count")
    sent = rows(ST.partial_highest(df, ["_bucket"], "obj", 3))
    assert sent == sorted((b, o, 2000 + o) for b in range(4) for o in (988 + b, 992 + b, 996 + b))


def test_late_rows_are_handed_on(spark, tmp_dir):
    data = [(0, "a", "2024-01-01 00:10:00"), (0, "a", "2024-01-01 05:00:00"),
            (1, "a", "2024-01-01 00:20:00"), (1, "b", "2024-01-01 00:30:00"),
            (1, "a", "2024-01-01 04:30:00"), (2, "a", "2024-01-03 00:00:00")]
    df = spark.createDataFrame(data, "batch int, user string, ts string").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz"))
    feed = BatchLog(spark, os.path.join(tmp_dir, "feed"))
    for s in SS.landed_batches(df, "batch", [0, 1, 2], os.path.join(tmp_dir, "in")):
        SO.run_available(SO.feed_writer(SO.window_counts(s, "ts", ["user"], 7200, 3600, "1 hour"), feed,
                                        os.path.join(tmp_dir, "ck"), by="kind"))
    late = feed.read().where("kind = 'late'").groupBy("user").agg(F.sum("count").alias("n"))
    assert rows(late) == [("a", 1), ("b", 1)]
    counted = feed.read().where("kind = 'count' AND user = 'a'").agg(F.sum("count")).first()[0]
    assert counted == 2 * 3   # 00:10, 05:00, 04:30 in two windows each; the last hour stays open


@pytest.mark.parametrize("lost", [None, 2])
def test_rolling_top_n_keeps_lists_of_open_windows(spark, tmp_dir, lost):
    df = _clicks(spark, 500, keys="abcdefgh")
    feed, queries = _windows(spark, tmp_dir, df, lambda s, delay: SO.rolling_top_n(
        s, "ts", "user", 3, 7200 * 3, 7200, delay, "weight"), lost)
    want = TK.top_by_count(WN.rolling_count(df, "ts", ["user"], 7200 * 3, 7200), "user", 3,
                           by=["window_end"])
    cols = ("window_end", "rank", "user", "count")
    assert rows(feed.latest(["window_end", "rank"]), *cols) == rows(want, *cols)
    assert _state_rows(queries[-1])[-1] == 0


def test_global_top_words_merge_partial_lists(spark, tmp_dir):
    rng = random.Random(8)
    words = [f"w{k:02d}" for k in range(40)]
    batches = [rng.choices(words, [1 / (k + 1) for k in range(40)], k=300) for _ in range(3)]
    batches[2] += ["w39"] * 200   # from the bottom to the top
    feed = _land(spark, tmp_dir, lambda s: SO.top_n(SO.keyed_counts(s, ["word"]).drop("prev_count"),
                                                    "word", 5, buckets=4), batches)
    for upto in range(3):
        count = Counter(w for ws in batches[:upto + 1] for w in ws)
        want = sorted(count.items(), key=lambda e: (-e[1], e[0]))[:5]
        seen = BatchLog.latest(type("Part", (), {
            "read": lambda self, u=upto: feed.read().where(f"batch_id <= {u}")})(), ["rank"])
        assert [(r["word"], r["count"]) for r in seen.orderBy("rank").collect()] == want


# ------------------------------------------------------------ joins

def _three_sides(spark, root, shift=1, extra=()):
    schemas = ["k int, name string, both string", "k int, town string, both string", "k int, age int"]
    data = [[(k, f"n{k}", f"first{k}") for k in range(12)], [(k, f"t{k}", "second") for k in range(10)],
            [(k, 20 + k) for k in range(11)]]
    streams = []
    for i, (schema, side) in enumerate(zip(schemas, data, strict=True)):
        df = spark.createDataFrame(side + [e[1] for e in extra if e[0] == i], schema).withColumn(
            "batch", F.pmod(F.col("k") + i * shift, F.lit(3)))
        streams.append(SS.landed_stream(df, "batch", 3, os.path.join(root, f"s{i}"), 2))
    return streams


@pytest.mark.parametrize("shift", [0, 1])
def test_natural_join_of_three_streams(spark, tmp_dir, shift):
    sides = _three_sides(spark, tmp_dir, shift)
    feed = LosesACommit(spark, os.path.join(tmp_dir, "feed"), 1)
    _run(SO.natural_join(sides, ["k", "age", "both", "name"]), feed, os.path.join(tmp_dir, "ck"))
    assert feed.written.count(1) == 2
    assert rows(feed.read(), "k", "age", "both", "name") == [
        (k, 20 + k, f"first{k}", f"n{k}") for k in range(10)]


def test_second_row_of_a_pending_side_is_an_error(spark, tmp_dir):
    sides = _three_sides(spark, tmp_dir, extra=[(0, (11, "again", "x"))])  # key 11 stays pending
    with pytest.raises(StreamingQueryException, match="second row of side 0"):
        SO.run_available(SO.feed_writer(SO.natural_join(sides, ["k", "age"]),
                                        BatchLog(spark, os.path.join(tmp_dir, "feed")),
                                        os.path.join(tmp_dir, "ck")))


def test_natural_join_checks_its_fields(spark, tmp_dir):
    sides = _three_sides(spark, tmp_dir)
    with pytest.raises(ValueError, match="not produced"):
        SO.natural_join(sides, ["k", "nothing"])
    with pytest.raises(ValueError, match="share no field"):
        SO.natural_join([sides[0], sides[1].drop("k", "both")], ["name"])
    with pytest.raises(ValueError, match="expiry needs"):
        SO.natural_join(sides, ["k"], within_seconds=3)


@pytest.mark.parametrize("lost", [None, 2])
def test_expired_sides_come_out_and_leave_the_state(spark, tmp_dir, lost):
    rng = random.Random(6)
    base = F.lit("2024-03-01").cast("timestamp_ntz")
    at = lambda c: F.timestamp_add("SECOND", F.col(c), base)
    data = [(k, rng.randrange(4 * DAY), rng.choice([0, 600, 1800, 1801, 9000, -1800, -4000]))
            for k in range(120)]
    df = spark.createDataFrame(data, "k int, s long, d long")
    left = df.where("k % 9 != 0").select("k", at("s").alias("ts"), F.concat(F.lit("l"), "k").alias("lv"))
    right = df.where("k % 10 != 0").withColumn("s", F.col("s") + F.col("d")).select(
        "k", at("s").alias("ts"), F.concat(F.lit("r"), "k").alias("rv"))
    parts, delay = DV.sides_in_arrival_order([left, right], "ts", "k", 4, 7200)
    streams = [SS.landed_stream(p.drop("weight"), "batch", 5, os.path.join(tmp_dir, f"s{i}"), 2)
               for i, p in enumerate(parts)]
    joined = SO.natural_join(streams, ["k", "lv", "rv"], "ts", 1800, delay)
    feed = LosesACommit(spark, os.path.join(tmp_dir, "feed"), lost)
    query = None
    for _ in range(2):
        try:
            query = SO.run_available(SO.feed_writer(joined, feed, os.path.join(tmp_dir, "ck")))
            break
        except StreamingQueryException as e:
            assert "executor lost" in str(e)
    want = []
    for k, _, d in data:
        sides = (1 if k % 9 else 0) | (2 if k % 10 else 0)
        if sides == 3 and abs(d) <= 1800:
            want.append((k, "joined", f"l{k}", f"r{k}"))
        else:
            want += [(k, "expired", f"l{k}", None)] * (sides & 1) + [(k, "expired", None, f"r{k}")] * (sides >> 1)
    got = [(r["k"], r["kind"], r["lv"], r["rv"]) for r in feed.read().collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    held = _state_rows(query)
    assert max(held) > 0 and held[-1] == 0


def test_sides_of_many_keys_share_values_of_the_state(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(SO, "BUCKETS", 4)
    base = F.lit("2024-03-01").cast("timestamp_ntz")
    df = spark.range(150).select("id", F.timestamp_add("SECOND", F.col("id") * 60, base).alias("ts"))
    sides = [df.withColumn("a", F.col("id")),
             df.withColumn("ts", F.timestamp_add("SECOND", F.col("id") * 30, F.col("ts")))
             .withColumn("b", F.col("id"))]
    parts, delay = DV.sides_in_arrival_order(sides, "ts", "id", 4, 600)
    streams = [SS.landed_stream(p.drop("weight"), "batch", 5, os.path.join(tmp_dir, f"s{i}"), 2)
               for i, p in enumerate(parts)]
    feed = BatchLog(spark, os.path.join(tmp_dir, "feed"))
    query = SO.run_available(SO.feed_writer(
        SO.natural_join(streams, ["id", "a", "b"], "ts", 1800, delay), feed,
        os.path.join(tmp_dir, "ck")))
    got = rows(feed.read().groupBy("kind", "sides").count())
    assert got == [("expired", 1, 89), ("expired", 2, 89), ("joined", 3, 61)]
    held = _state_rows(query)
    assert 0 < max(held) <= 8 and held[-1] == 0


def test_time_bounded_join_of_streams(spark, tmp_dir):
    """Spark's own interval join: a left row whose partner does not arrive within the
    bound is emitted with a NULL right side once the watermark passes it."""
    land_l, land_r = os.path.join(tmp_dir, "l"), os.path.join(tmp_dir, "r")
    # k=1 matches; k=2's partner is 2 h late; k=9 rows only move the watermarks on.
    spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:00")],
                          "k int, lt string").write.parquet(os.path.join(land_l, "a"))
    spark.createDataFrame([(1, "2024-01-01 00:10:00"), (2, "2024-01-01 02:00:00")],
                          "k int, rt string").write.parquet(os.path.join(land_r, "a"))
    ck, out = os.path.join(tmp_dir, "ck"), os.path.join(tmp_dir, "out")

    def run():
        left = (SS.parquet_stream(spark, os.path.join(land_l, "*"), "k int, lt string")
                .withColumn("lt", F.col("lt").cast("timestamp")).withWatermark("lt", "30 minutes"))
        right = (SS.parquet_stream(spark, os.path.join(land_r, "*"), "k int, rt string")
                 .withColumn("rt", F.col("rt").cast("timestamp")).withWatermark("rt", "30 minutes"))
        j = JN.time_bounded_join(left, right, ["k"], "lt", "rt", 1800, how="left_outer").select(
            F.col("l.k").alias("k"), F.col("r.k").alias("rk"))
        SO.run_available(j.writeStream.format("parquet").option("path", out)
                         .option("checkpointLocation", ck))

    run()
    spark.createDataFrame([(9, "2024-01-02 00:00:00")], "k int, lt string").write.parquet(
        os.path.join(land_l, "b"))
    spark.createDataFrame([(9, "2024-01-02 00:00:00")], "k int, rt string").write.parquet(
        os.path.join(land_r, "b"))
    run()
    got = [r for r in rows(spark.read.parquet(out)) if r[0] != 9]
    assert got == [(1, 1), (2, None)]


# ------------------------------------------------------------ aggregates and proximity

def test_stream_word_count_restart_equals_batch(spark, tmp_dir):
    land = os.path.join(tmp_dir, "in")
    docs = [("green tea and black tea",), ("a kettle for the tea",)]
    more = [("no tea no kettle",)]
    spark.createDataFrame(docs, "text string").write.parquet(os.path.join(land, "a"))
    out = BatchLog(spark, os.path.join(tmp_dir, "out"))

    def run():
        s = SS.parquet_stream(spark, os.path.join(land, "*"), "text string")
        SO.run_available(SO.feed_writer(AG.word_count(s, "text"), out, os.path.join(tmp_dir, "ck")))

    run()
    spark.createDataFrame(more, "text string").write.parquet(os.path.join(land, "b"))
    run()   # restart: same checkpoint, only the new file is read
    batch = AG.word_count(spark.createDataFrame(docs + more, "text string"), "text")
    assert rows(out.latest(["word"])) == rows(batch)
    # the second batch only wrote the words it changed
    assert rows(out.read().where("batch_id = 1"), "word") == [("kettle",), ("no",), ("tea",)]


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_stored_summary_flags_like_the_batch(spark, tmp_dir, monkeypatch, limit):
    """Broadcast, and salted beyond the limit."""
    monkeypatch.setattr(JN, "SUMMARY_BROADCAST_ROWS", limit)
    rng = random.Random(2)
    quakes = spark.createDataFrame([(rng.randrange(10**8),) for _ in range(12)], "time long")
    # A third of the messages in one bucket.
    msgs = spark.createDataFrame([(k, rng.randrange(10**8) if k % 3 else 5 * 10**7 + k, )
                                  for k in range(600)] + [(900, None)], "id int, published long")
    summary = JN.stored_near_summary(quakes, "time", os.path.join(tmp_dir, "q"))
    got = rows(JN.flag_by_summary(msgs, summary, "published"), "id", "near")
    assert got == rows(JN.near_flag(msgs, quakes, "published", "time"), "id", "near")
    times = [r["time"] for r in quakes.collect()]
    assert dict(got) == {r["id"]: r["published"] is not None and any(
        abs(r["published"] - t) < JN.NEAR_WITHIN_MS for t in times) for r in msgs.collect()}

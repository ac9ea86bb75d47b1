"""Randomised checks: results must not depend on how rows are cut into
micro-batches, and operators must agree with brute force."""

import os
import tempfile
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rivulet.operators import aggregates as AG
from rivulet.operators.reach import reach
from rivulet.sinks.tables import BatchLog
from rivulet.streaming import operators as SO
from rivulet.streaming import sources as SS
from tests.conftest import rows

_SETTINGS = settings(max_examples=6, deadline=None,
                     suppress_health_check=[HealthCheck.function_scoped_fixture])

words = st.lists(st.sampled_from(["a", "b", "c", "d"]), min_size=1, max_size=30)


@_SETTINGS
@given(ws=words, cuts=st.lists(st.integers(0, 3), min_size=30, max_size=30))
def test_count_with_prev_matches_python(spark, ws, cuts):
    batches = sorted(cuts[: len(ws)])
    df = spark.createDataFrame(list(zip(ws, batches)), "word string, batch_id int")
    got = rows(AG.count_with_prev(df, "word", "batch_id"), "word", "batch_id", "count", "prev_count")
    want, running = [], Counter()
    for b in sorted(set(batches)):
        here = Counter(w for w, bb in zip(ws, batches) if bb == b)
        for w, n in here.items():
            prev = running[w] if running[w] else None
            running[w] += n
            want.append((w, b, running[w], prev))
    assert got == sorted(want)
    # The final histogram does not depend on the split either.
    hist = dict(rows(AG.count_histogram(
        df.groupBy("word").count().withColumnRenamed("count", "count"))))
    assert sum(hist.values()) == len(set(ws))


@settings(_SETTINGS, max_examples=2)
@given(ws=words, cuts=st.lists(st.integers(0, 2), min_size=30, max_size=30))
def test_keyed_counts_independent_of_split(spark, ws, cuts):
    root = tempfile.mkdtemp(prefix="rivulet-prop-")
    df = spark.createDataFrame(list(zip(ws, cuts)), "word string, batch int")
    feed = BatchLog(spark, os.path.join(root, "feed"))
    for stream in SS.landed_batches(df, "batch", [0, 1, 2], os.path.join(root, "in")):
        SO.run_available(SO.feed_writer(SO.keyed_counts(stream, ["word"]), feed,
                                        os.path.join(root, "ck")))
    assert dict(rows(feed.latest(["word"]), "word", "count")) == dict(Counter(ws))


@_SETTINGS
@given(edges=st.lists(st.tuples(st.integers(0, 5), st.integers(0, 6)), min_size=1, max_size=25),
       follow=st.lists(st.tuples(st.integers(0, 6), st.integers(0, 9)), min_size=1, max_size=25))
def test_reach_matches_brute_force(spark, edges, follow):
    req = spark.createDataFrame([(u, u) for u in range(7)], "request_id int, url int")
    tw = spark.createDataFrame(edges, "url int, tweeter int")
    fo = spark.createDataFrame(follow, "tweeter int, follower int")
    got = dict(rows(reach(req, tw, fo)))
    want = {u: len({f for (uu, t) in edges if uu == u for (tt, f) in follow if tt == t})
            for u in range(7)}
    assert got == want

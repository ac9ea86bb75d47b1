"""Streams over tables of several part files, out of time order, and NULLs."""

import os

import duckdb
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rivulet.operators import bayes as BY
from rivulet.plans import derived as DV
from rivulet.plans import registry
from rivulet.streaming import sources as SS
from tests.conftest import SF_SMALL, rows
from tests.test_queries import _canon

STREAMS = ["stream_word_count", "stream_max_by_symbol", "stream_rolling_count",
           "stream_rolling_top_n", "stream_rolling_count_zeros", "stream_join_expiry",
           "tick_trigger", "stream_near_word_counts", "stream_near_totals",
           "stream_near_posterior"]
PARTS = {"events": "event_id", "documents": "doc_id", "lineitem": "l_orderkey"}


@pytest.fixture(scope="module")
def parted(tmp_path_factory):
    """Three tables as folders of four part files by key modulo 4, so that times
    are out of order across files; a share of the events has NULLs."""
    root = tmp_path_factory.mktemp("parted")
    for name, key in PARTS.items():
        t = pq.read_table(os.path.join(SF_SMALL, f"{name}.parquet"))
        k = t[key].to_pandas()
        if name == "events":
            value = pc.if_else((k % 10 == 3).to_numpy(), None, t["value"])
            t = t.set_column(t.schema.get_field_index("value"), "value", value)
        folder = root / f"{name}.parquet"
        folder.mkdir()
        for part in range(4):
            pq.write_table(t.filter((k % 4 == part).to_numpy()), folder / f"part-{part}.parquet")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in PARTS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{root}/{name}.parquet/*')")
    yield str(root), con
    con.close()


@pytest.mark.parametrize("name", STREAMS)
def test_stream_over_part_files_equals_batch(spark, parted, monkeypatch, name):
    root, con = parted
    monkeypatch.setattr(SS, "MAX_FILES", 1)  # four micro-batches
    df = registry.queries()[name](spark, root)
    res = con.execute(registry.oracles()[name])
    names = [d[0] for d in res.description]
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(names, res.fetchall())


def test_every_event_is_a_quake_or_a_message(spark, parted):
    root, _ = parted
    events = spark.read.parquet(os.path.join(root, "events.parquet"))
    assert events.where(F.col("value").isNull()).count() > 0
    assert (DV.quakes(spark, root).count() + DV.messages(spark, root).count()) == events.count()


def test_long_requests_keep_their_answer(spark):
    """Three hundred words, all known to both classes: the product underflows."""
    words = [f"w{k}" for k in range(300)]
    counts = spark.createDataFrame([(c, w, 1 + (k + c) % 3) for k, w in enumerate(words)
                                    for c in (False, True)], "near boolean, word string, word_count long")
    totals = spark.createDataFrame([(True, 2000), (False, 3000)], "near boolean, message_count long")
    req = spark.createDataFrame([(1, " ".join(words)), (2, "w1 w2"), (3, "unknown")],
                                "request_id int, args string")
    got = dict(rows(BY.posterior(req, counts, totals)))
    import math

    def want(ws):
        logs = {c: math.log((2000 if c else 3000) / 5000) + sum(
            math.log((1 + (words.index(w) + c) % 3) / (2000 if c else 3000)) for w in ws)
            for c in (False, True)}
        return 1 / (1 + math.exp(logs[False] - logs[True]))

    assert got[1] == pytest.approx(want(words), rel=1e-9) and 0 <= got[1] <= 1
    assert got[2] == pytest.approx(want(["w1", "w2"]), rel=1e-9)
    assert got[3] == pytest.approx(0.4)

"""Session helpers: shared folders, table loading, materialisation, empty sinks."""

import io
import os
from contextlib import redirect_stdout

import pytest

import rivulet.session as RS
from rivulet.sinks.tables import BatchLog
from tests.conftest import SF_SMALL, rows


def test_checkpoint_dir_is_read_from_the_session(spark):
    d = RS.checkpoint_dir(spark)
    assert d and d == spark.sparkContext.getCheckpointDir()
    p = RS.scratch_path(spark, "x")
    assert p.startswith(d) and p != RS.scratch_path(spark, "x")


def test_table_pushdown_and_pruning(spark):
    df = RS.table(spark, SF_SMALL, "events")
    out = io.StringIO()
    with redirect_stdout(out):
        df.where("event_type = 'click'").select("event_id").explain("formatted")
    buf = out.getvalue()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in buf
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in buf
    assert "Exchange" not in buf


def test_a_cluster_needs_a_shared_folder():
    class Context:
        def __init__(self, master):
            self.master = master

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context("spark://host:7077")

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        RS.checkpoint_dir(Session())


def test_materialize_writes_under_checkpoint_dir(spark):
    df = spark.range(10).withColumnRenamed("id", "x")
    m = RS.materialize(df, "mat")
    assert sorted(r.x for r in m.collect()) == list(range(10))

    def bare(u):
        return "/" + u.split(":", 1)[-1].lstrip("/") if ":" in u else u

    base = bare(RS.checkpoint_dir(spark))
    assert m.inputFiles() and all(bare(f).startswith(base) for f in m.inputFiles())


def test_empty_feed_reads_as_none(spark, tmp_dir):
    feed = BatchLog(spark, os.path.join(tmp_dir, "b"))
    assert feed.read() is None and feed.latest(["k"]) is None
    feed.write(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), 0)
    feed.write(spark.createDataFrame([("a", 2)], "k string, v int"), 1)
    feed.write(spark.createDataFrame([("a", 3)], "k string, v int"), 1)  # a replay
    assert rows(feed.latest(["k"])) == [("a", 3), ("b", 1)]

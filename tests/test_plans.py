"""Physical-plan shape: pushdown, pruning, no pairwise joins, partial top-k."""

import io
from contextlib import redirect_stdout

from rivulet.plans import registry
from tests.conftest import SF_MID


def _plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_scan_prunes_columns(spark):
    p = _plan(registry.queries()["page_title"](spark, SF_MID))
    assert "ReadSchema: struct<page_id:bigint,html:string>" in p


def test_filter_pushed_to_scan(spark):
    p = _plan(registry.queries()["near_flag"](spark, SF_MID))
    pushed = [ln for ln in p.splitlines() if ln.startswith("PushedFilters")]
    assert any("EqualTo(event_type,error)" in ln and "GreaterThan(value,150.0)" in ln
               for ln in pushed)


def test_near_flag_has_no_pairwise_join(spark):
    p = _plan(registry.queries()["near_flag"](spark, SF_MID))
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p


def test_no_pairwise_joins_anywhere(spark):
    qs = registry.queries()
    for name in ["reach", "near_posterior", "rolling_window_length", "word_sum_query",
                 "keyed_lookup", "lookup_join", "natural_join_3"]:
        p = _plan(qs[name](spark, SF_MID))
        assert "NestedLoopJoin" not in p and "CartesianProduct" not in p, name


def test_top_n_uses_partial_window_group_limit(spark):
    p = _plan(registry.queries()["top_words"](spark, SF_MID))
    assert "WindowGroupLimit" in p
    assert "Partial" in p.split("WindowGroupLimit", 2)[-1] or p.count("WindowGroupLimit") >= 2


def test_aggregations_are_partial_before_shuffle(spark):
    p = _plan(registry.queries()["word_count"](spark, SF_MID))
    assert p.count("HashAggregate") >= 2   # partial (map side) + final

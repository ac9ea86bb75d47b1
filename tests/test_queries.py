"""Every registered query against its SQL oracle (DuckDB) on sf0.001, and
the flagship entry point."""

import math
import os

import pytest

import __spark_entry__ as E
from rivulet.plans import registry
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _canon(cols, rs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rs]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0)
                                           for x in r))


def test_every_query_has_a_callable_and_oracles_are_known():
    assert set(E.oracle_sql()) <= set(E.queries())
    qs, sql = registry.queries(), registry.oracles()
    assert set(qs) <= set(E.queries())
    assert len(qs) >= 60
    assert set(sql) == set(qs)


@pytest.mark.parametrize("name", sorted(registry.oracles()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    s_cols, s_rows = sdf.columns, [tuple(r) for r in sdf.collect()]
    res = duck.execute(E.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _canon(s_cols, s_rows) == _canon(d_cols, d_rows)


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.columns == ["request_id", "p_quake_given_tweet"]
    n = df.count()
    assert n > 0
    vals = [r[1] for r in df.collect() if r[1] is not None]
    assert all(0.0 <= v <= 1.0 for v in vals)
    assert os.path.isdir(SF_SMALL)

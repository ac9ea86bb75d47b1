"""Registry of named queries and their independent SQL oracles.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the driver tables in
``sf_dir``. The oracle is ANSI SQL over the same tables (DuckDB dialect),
written from the definition, not from the Spark plan. A query without an
oracle is checked on row count only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: add ``fn`` under ``name`` (with an optional SQL oracle)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle.strip()
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules runs their @register decorators.
    from rivulet.plans import (  # noqa: F401
        feed_jobs, quake, sinks_jobs, stream_jobs, table_jobs, text_jobs, window_jobs,
    )


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)

"""Registry of the named queries and their oracle SQL.

Every query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
given tables.  The oracle is DuckDB SQL over the same tables registered as
views; queries without one are checked on row counts only (model operators,
HTML parsing, streaming).
"""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, Callable[[], str]] = {}


def register(name: str, sql: Callable[[], str] | None = None):
    """Decorator: add a query under ``name`` with an optional SQL builder."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn

    return deco


def _load_all() -> None:
    # Importing the query modules fills the registry.
    from textmill.plans import (  # noqa: F401
        q_clusters,
        q_scalars,
        q_sentiment,
        q_streams,
        q_terms,
        q_web,
    )


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    out = {}
    for k, build in _ORACLE.items():
        try:
            out[k] = build()
        except Exception as e:  # one key's failure must not hide the others
            warnings.warn(f"no oracle SQL for {k}: {e!r}", stacklevel=2)
    return out

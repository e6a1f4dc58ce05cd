"""Named queries over the driver's tables (``queries()``) and their oracle SQL."""

from __future__ import annotations

from . import (devicelog_queries, row_queries, sink_queries, stream_queries,  # noqa: F401
               text_queries, window_queries)
from .registry import REGISTRY, Query, query


def queries():
    return {name: q.fn for name, q in REGISTRY.items()}


def oracle_sql():
    return {name: q.sql for name, q in REGISTRY.items() if q.sql is not None}


__all__ = ["REGISTRY", "Query", "query", "queries", "oracle_sql"]

"""Registered queries: every operator on the driver's tables, with its check in SQL."""

from __future__ import annotations

from . import (
    documents,
    expressions,
    joins,
    measures,
    published,
    rows,
    sets,
    stateful,
    streams,
    summaries,
)
from .registry import oracle_sql, queries

__all__ = ["documents", "expressions", "joins", "measures", "oracle_sql", "published",
           "queries", "rows", "sets", "stateful", "streams",
           "summaries"]

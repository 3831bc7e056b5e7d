"""The registered queries over the driver's tables, each with its SQL twin."""

from __future__ import annotations

from tidemark.plans import change_queries, event_queries, stream_queries

_MODULES = (event_queries, change_queries, stream_queries)

QUERIES = {name: run for m in _MODULES for name, run in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}

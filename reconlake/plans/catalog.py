"""All queries of the core library by name."""

from __future__ import annotations

from reconlake.plans import data_queries, engine_queries, extraction_queries, record_queries, source_queries

FLAGSHIP = "line_amounts"
_MODULES = (data_queries, engine_queries, extraction_queries, record_queries, source_queries)


def queries() -> dict:
    return {k: v for m in _MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in _MODULES for k, v in m.ORACLES.items()}

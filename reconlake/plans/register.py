"""Collects the queries of a module with their SQL."""

from __future__ import annotations

from collections.abc import Callable


def collector() -> tuple[dict[str, Callable], dict[str, str], Callable]:
    """(queries, their SQL, decorator that adds a query by its name, with SQL if there is any)."""
    queries: dict[str, Callable] = {}
    oracles: dict[str, str] = {}

    def query(sql: str = "") -> Callable:
        def add(f: Callable) -> Callable:
            queries[f.__name__] = f
            if sql:
                oracles[f.__name__] = sql
            return f

        return add

    return queries, oracles, query

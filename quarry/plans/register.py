"""How a module of queries names them."""

from __future__ import annotations

from collections.abc import Callable


def registry() -> tuple[dict, dict, Callable]:
    """(queries, SQL, decorator): the decorator enters a function under its name, with its SQL if there is any."""
    queries: dict = {}
    oracles: dict = {}

    def query(sql: str | None = None):
        def add(f):
            queries[f.__name__] = f
            if sql:
                oracles[f.__name__] = sql
            return f

        return add

    return queries, oracles, query

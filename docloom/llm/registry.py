"""The registered queries of this package and their DuckDB text."""

from __future__ import annotations

QUERIES = {}
ORACLE = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register

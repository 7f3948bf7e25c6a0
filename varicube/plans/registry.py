"""Where queries and their SQL are noted."""

from __future__ import annotations

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def note(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return note

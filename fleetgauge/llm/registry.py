"""Queries of this subpackage over the test tables; SQL where SQL can say the same."""

from __future__ import annotations

from ..plans.registry import table  # noqa: F401

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register

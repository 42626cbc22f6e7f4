"""Queries and oracles of this subpackage."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, oracle: str | None = None):
    """Register a query function under ``name`` with its oracle SQL."""

    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add

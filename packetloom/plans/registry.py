"""Registered queries and the SQL that must give the same rows."""

from __future__ import annotations

QUERIES = {}
ORACLES = {}


def query(sql=None, name=None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under its name, with its SQL."""

    def add(fn):
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql:
            ORACLES[key] = sql
        return fn

    return add

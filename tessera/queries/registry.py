"""Query registry: each entry is a Spark callable ``(spark, sf_dir)`` and,
where the result is SQL-expressible, the DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def ts(c):
    """Timestamps leave both engines as the same text."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd HH:mm:ss")


def ts_sql(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)

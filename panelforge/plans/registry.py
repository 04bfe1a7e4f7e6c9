"""Registry of named queries: Spark builder + optional DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    fn: QueryFn
    oracle: str | None
    operators: str  # SURVEY ids covered, e.g. "A9 W4-W8"


REGISTRY: dict[str, Query] = {}


def register(name: str, operators: str = "", oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, oracle, operators)
        return fn

    return deco


def rsql(sql: str, doubles: list[str] | tuple[str, ...] = ()) -> str:
    """Wrap an oracle query so the listed double columns are rounded to 6 dp."""
    if not doubles:
        return sql
    rep = ", ".join(f"round(CAST({c} AS DOUBLE) + 1e-9, 6) AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS _q"

"""Registry of named queries: a Spark builder plus (optionally) its DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    name: str
    build: Builder
    sql: str | Callable[[], str] | None
    bench: bool = False

    def oracle(self) -> str | None:
        return self.sql() if callable(self.sql) else self.sql


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | Callable[[], str] | None = None, bench: bool = False):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        REGISTRY[name] = Entry(name, fn, sql, bench)
        return fn
    return deco


def load_all() -> dict[str, Entry]:
    # Importing the plan modules fills REGISTRY.
    from quarry.plans import (  # noqa: F401
        clusters, factors, graphs, io_plans, learning, patterns, recs, relational, similarity, streams,
    )
    return REGISTRY

"""Queries by name, each with the SQL another engine checks it with (or none)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


CATALOG: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register the decorated function; the SQL must give the same columns and rows."""
    def register(run: Run) -> Run:
        if name in CATALOG:
            raise ValueError(f"two queries named {name}")
        CATALOG[name] = Query(run, sql)
        return run
    return register

"""Name -> (Spark query, SQL that gives the same rows)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    query: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        ENTRIES[name] = Entry(fn, sql)
        return fn
    return register

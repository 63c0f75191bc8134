"""Named queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Check:
    name: str
    query: Query
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under an operator's name."""

    def add(query: Query) -> Query:
        if name in CHECKS:
            raise ValueError(f"duplicate check {name}")
        CHECKS[name] = Check(name, query, sql)
        return query

    return add

"""Sorting, appending and turning results into other shapes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def metrics_to_rows(df: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Metric columns as rows (``metric``, ``value``)."""
    return df.unpivot(list(ids), list(metrics), "metric", "value")


def periods_to_columns(df: DataFrame, row: str, period: str, periods: Sequence, value: str = "value") -> DataFrame:
    """Periods as columns; they are given, so no extra job has to find them."""
    return df.groupBy(row).pivot(period, list(periods)).agg(F.first(value, ignorenulls=True))


def keyed_map(df: DataFrame, key: str, metrics: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """One map (key -> value) per metric for each combination of ``groups``.

    A map is one value of one row, so ``groups`` should leave few keys to each; a result that has no such
    columns stays a table of (metric, key, value), see ``metrics_to_rows``.
    """
    maps = [F.map_from_entries(F.sort_array(F.collect_list(F.struct(key, m)))).alias(m) for m in metrics]
    return df.groupBy(*groups).agg(*maps)


def to_records(df: DataFrame, out: str = "record") -> DataFrame:
    """Every row as one JSON record."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(out))


def append_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, by column name; missing columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def sort_by_abs(df: DataFrame, column: str, *tie_breaks: str) -> DataFrame:
    """Largest absolute value first. Tie-breaks also let the sort spread equal values over tasks."""
    return df.orderBy(F.abs(column).desc(), *tie_breaks)

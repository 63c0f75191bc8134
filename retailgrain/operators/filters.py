"""Row filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F


def date_range(df: DataFrame, column: str, start: dt.date, end: dt.date, closed: str = "left") -> DataFrame:
    """Rows from ``start`` up to ``end``; ``closed='both'`` also takes ``end`` at midnight.

    Both bounds are plain literals of the column's type, so the scan can use them.
    """
    kind = df.schema[column].dataType
    low, high = F.lit(start).cast(kind), F.lit(end).cast(kind)
    upper = F.col(column) <= high if closed == "both" else F.col(column) < high
    return df.where((F.col(column) >= low) & upper)


def not_equal_keep_null(column: Column, value) -> Column:
    """True unless the column equals the value; NULL counts as different."""
    return ~column.eqNullSafe(F.lit(value))


def on_day(df: DataFrame, column: str, day: dt.date) -> DataFrame:
    """Rows of one calendar day, as a half-open range the scan can prune with."""
    return date_range(df, column, day, day + dt.timedelta(days=1))


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with a NULL in any grouping key are left out of the grouped result."""
    return df.dropna(subset=list(keys))


def all_present(keys: list[str]) -> Column:
    """Aggregate that is true where no grouping key is NULL.

    A filter on it drops the same groups as ``drop_null_keys``, but stays above the
    aggregate. That matters where the aggregate is used twice: a filter pushed into
    one of the uses would make Spark compute it twice.
    """
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return F.bool_and(present)

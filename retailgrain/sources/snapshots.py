"""Stored results that are recomputed when they are too old."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

RUN_DATE = "run_date"


def latest_run(spark: SparkSession, path: str) -> dt.date | None:
    """Newest stored run date; only the partition column is read."""
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return stored.agg(F.max(F.col(RUN_DATE).cast("date"))).first()[0]


def is_stale(stored: dt.date | None, as_of: dt.date, ttl_days: int | None) -> bool:
    if stored is None:
        return True
    return ttl_days is not None and (as_of - stored).days >= ttl_days


def invalidate_after(stored: dt.date | None, uploaded: dt.date | None) -> bool:
    """Whether an upload is newer than the stored result."""
    return uploaded is not None and (stored is None or uploaded >= stored)


def snapshot_if_stale(
    spark: SparkSession,
    path: str,
    as_of: dt.date,
    build: Callable[[], DataFrame],
    ttl_days: int | None = 1,
    force: bool = False,
) -> DataFrame:
    """The stored result, rebuilt first when it is ``ttl_days`` or more days old.

    ``ttl_days=None`` never expires; ``force`` rebuilds after new input. A rerun of
    the same day replaces that day's partition only.
    """
    stored = latest_run(spark, path)
    if force or is_stale(stored, as_of, ttl_days):
        result = build().withColumn(RUN_DATE, F.lit(as_of).cast("date"))
        result.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN_DATE).parquet(path)
        stored = as_of
    rows = spark.read.parquet(path)
    return rows.where(F.col(RUN_DATE).cast("date") == F.lit(stored)).drop(RUN_DATE)

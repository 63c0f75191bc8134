"""Vector columns: which rows take part, and rows as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str, size: int) -> Column:
    """Whether a vector has the size, only finite components and not only zeros."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) == size) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def common_size(df: DataFrame, vector: str) -> int:
    """The most frequent size of a vector, the smaller of two that are equally frequent; 0 without vectors."""
    sizes = df.where(F.col(vector).isNotNull()).groupBy(F.size(vector).alias("size")).agg(F.count("*").alias("n"))
    best = sizes.where("size > 0").orderBy(F.desc("n"), "size").limit(1).collect()
    return best[0]["size"] if best else 0


def matrix(column, size: int, kind=np.float64) -> np.ndarray:
    """A list column without nulls as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, size)


def dots(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed alike for every row, so that equal rows tie."""
    return (rows.astype(np.float64) * one.astype(np.float64)).sum(axis=1)

"""Sums of fixed-size arrays over all partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK = 1 << 12


def total(df: DataFrame, size: int, count: Callable[[pa.RecordBatch, np.ndarray], None]) -> np.ndarray:
    """``count`` adds each batch of ``df`` to an array of ``size`` int64; the arrays are summed.

    A task sends its array in chunks, and each chunk is summed by a stream over its parts. The
    size of the result, which comes to the driver, is a parameter and does not grow with the data.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(size, np.int64)
        for batch in batches:
            count(batch, own)
        parts = [own[i : i + CHUNK] for i in range(0, size, CHUNK)]
        used = [i for i, p in enumerate(parts) if p.any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([parts[i].tobytes() for i in used], pa.binary())], ["chunk", "sums"]
        )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(raw, np.int64)
                sums[i] = sums[i] + part if i in sums else part
        for i, part in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["chunk", "sums"])

    out = np.zeros(size, np.int64)
    chunks = df.mapInArrow(partial, "chunk int, sums binary").repartition("chunk").mapInArrow(merge, "chunk int, sums binary")
    found = chunks.toArrow()
    for i, raw in zip(found["chunk"].to_pylist(), found["sums"].to_pylist(), strict=True):
        out[i * CHUNK : i * CHUNK + len(raw) // 8] += np.frombuffer(raw, np.int64)
    return out

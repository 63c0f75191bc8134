"""Weekly counts that batch and stream share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from retailgrain.functions.dates import week_start
from retailgrain.functions.numbers import amount_parts, total_of_parts
from retailgrain.streaming.parts import PartStore

COUNTS = ("row_count", "value_whole", "value_rest", "value_unfit")


def partial_counts(rows: DataFrame, ts: str, keys: Sequence[str], value: str) -> DataFrame:
    """Rows and value sums per week and keys, in parts that can be added up."""
    sums = [F.count(F.lit(1)), *amount_parts(F.col(value))]
    return rows.groupBy(week_start(F.col(ts)).alias("week_start"), *keys).agg(*[s.alias(c) for s, c in zip(sums, COUNTS)])


def added_counts(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return parts.groupBy("week_start", *keys).agg(*[F.sum(c).alias(c) for c in COUNTS])


def totals(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    value = total_of_parts(*[F.col(c) for c in COUNTS[1:]])
    return added_counts(parts, keys).select("week_start", *keys, "row_count", value.alias("value_sum"))


def weekly_counts(rows: DataFrame, ts: str, keys: Sequence[str], value: str) -> DataFrame:
    """Rows and exact value sum per week and keys."""
    return totals(partial_counts(rows, ts, keys, value), keys)


def weekly_counts_stream(
    spark: SparkSession,
    stream: DataFrame,
    ts: str,
    keys: Sequence[str],
    value: str,
    out_path: str,
    checkpoint: str,
    fold_after: int = 64,
) -> DataFrame:
    """Process everything available and return the counts per week.

    Counts and sums add up, so each micro-batch stores those of its own rows. There is no state and no watermark: a
    row counts however late it comes. A batch that is repeated after a failure counts once, and every ``fold_after``
    parts are folded into one; ``fold_batches`` does so at any time, beside the running stream.
    """
    store = PartStore(spark, out_path)

    def write_part(rows: DataFrame, batch_id: int) -> None:
        if not store.taken(batch_id):
            store.commit(batch_id, [store.stage("counts", partial_counts(rows, ts, keys, value), batch_id)])
        if len(store.manifest().of("counts")) >= fold_after:
            fold_batches(spark, out_path, keys)

    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write_part)
        .start()
    )
    query.awaitTermination()
    return stored_counts(spark, out_path, keys)


def stored_counts(spark: SparkSession, folder: str, keys: Sequence[str]) -> DataFrame:
    """The counts of all batches that are stored, folded or not; each batch once, whatever runs beside."""
    return totals(PartStore(spark, folder).read("counts"), keys)


def fold_batches(spark: SparkSession, folder: str, keys: Sequence[str]) -> bool:
    """Add up the stored parts in one; the stream may go on. False if another fold was first."""
    return PartStore(spark, folder).fold({"counts": lambda parts: added_counts(parts, keys)})

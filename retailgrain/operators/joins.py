"""Equi-joins, outer matching, lookups and densifying."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from retailgrain.operators.skew import attach_group_totals, never_null, spread


def map_lookup(df: DataFrame, column: str, mapping: DataFrame, source: str, target: str) -> DataFrame:
    """Replace values found in the mapping table, keep all others.

    No hint is given: a mapping below the broadcast threshold is broadcast by its
    known size, a larger one is joined on the key.
    """
    pairs = mapping.select(F.col(source).alias("_from"), F.col(target).alias("_to"))
    joined = df.join(pairs, df[column] == F.col("_from"), "left")
    return joined.withColumn(column, F.coalesce("_to", column)).drop("_from", "_to")


def full_outer_match(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, side: str = "side", chunk: int = 100_000
) -> DataFrame:
    """Full outer equi-join that keeps both key columns and says where a row came from: ``both``, ``left`` or ``right``.

    Both sides are read once, as one tagged union. ``attach_group_totals`` tells each row how many rows of either side have its
    key, without gathering a hot key in one task. Rows that nobody matches are done. The others meet by key; where the
    larger side of a key has more than ``chunk`` rows, it is cut into parts and the smaller side goes to each of them.
    """
    nothing = lambda df: F.lit(None).cast(T.StructType([T.StructField(f.name, f.dataType) for f in df.schema]))

    def tagged(df: DataFrame, key: str, *sides: Column) -> DataFrame:
        known = F.col(key).isNotNull().alias("_known")
        return df.select(never_null(df, key).alias("_k"), known, *[c.alias(name) for c, name in zip(sides, ("_l", "_r"))])

    rows = tagged(left, left_key, F.struct(*left.columns), nothing(right)).unionAll(
        tagged(right, right_key, nothing(left), F.struct(*right.columns))
    )
    n = spread(rows)
    one = lambda c: F.when(F.col("_known") & F.col(c).isNotNull(), 1).otherwise(0)
    counted = attach_group_totals(rows, ["_k"], {"_nl": one("_l"), "_nr": one("_r")}, n)
    on_left = F.col("_r").isNull()
    # How many rows of the other side have the key, below 0 on the right.
    others = F.when(~F.col("_known"), F.lit(0)).when(on_left, F.col("_nr")).otherwise(-F.col("_nl"))
    # Up to four parts a partition, as their places are drawn by hash.
    parts = F.least(F.ceil(F.greatest("_nl", "_nr") / chunk), F.lit(4 * n)).cast("int")
    is_cut = F.when(on_left, F.col("_nl") >= F.col("_nr")).otherwise(F.col("_nl") < F.col("_nr"))
    own = F.pmod(F.xxhash64("_l", "_r"), F.when(others != 0, F.greatest(parts, F.lit(1))).otherwise(F.lit(n))).cast("int")
    copies = F.when((others != 0) & ~is_cut & (parts > 1), F.sequence(F.lit(0), parts - 1)).otherwise(F.array(F.lit(-1)))
    placed = counted.withColumn("_copy", F.explode(copies))
    part = F.coalesce(F.when(F.col("_copy") >= 0, F.col("_copy")).otherwise(own), F.lit(0))
    # The three uses share one exchange: a test that is not deterministic is not pushed below it.
    here = F.when(F.monotonically_increasing_id() >= 0, others)
    moved = placed.repartition(n, "_k", part).select("*", part.alias("_at"), here.alias("_others"))

    a = moved.where("_others > 0").select(F.col("_k").alias("_ka"), F.col("_at").alias("_pa"), "_l")
    b = moved.where("_others < 0").select(F.col("_k").alias("_kb"), F.col("_at").alias("_pb"), "_r")
    both = a.join(b, (F.col("_ka") == F.col("_kb")) & (F.col("_pa") == F.col("_pb"))).select("_l", "_r", F.lit("both").alias(side))
    alone = moved.where("_others = 0").select("_l", "_r", F.when(on_left, "left").otherwise("right").alias(side))
    return both.unionAll(alone).select("_l.*", "_r.*", side)


def densify(
    df: DataFrame,
    section: str,
    sections: Sequence[str],
    key: str,
    domain: DataFrame,
    metrics: Sequence[str],
) -> DataFrame:
    """Make every value of the domain present in every named section, with zeros where it had no row.

    The wanted (section, key) rows come from exploding the fixed section list
    beside each distinct domain value, and are added as zero rows to one grouped sum.
    """
    zeros = [F.lit(0).cast(df.schema[m].dataType).alias(m) for m in metrics]
    wanted = domain.select(key).where(F.col(key).isNotNull()).distinct().select(
        F.explode(F.lit(list(sections))).alias(section), key, *zeros
    )
    rows = df.select(section, key, *metrics).unionByName(wanted)
    return rows.groupBy(section, key).agg(*[F.sum(m).alias(m) for m in metrics])


def with_total(df: DataFrame, total: DataFrame, fields: Sequence[str], out: str = "_total") -> DataFrame:
    """Put a one-row total beside every row, as a struct from a scalar subquery."""
    one = total.select(F.struct(*[F.col(f) for f in fields]).alias(out))
    return df.withColumn(out, one.scalar())


def composite_left(df: DataFrame, other: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Left join on several (left, right) column pairs; the right key columns are dropped."""
    cond: Column = F.lit(True)
    for left, right in pairs:
        cond = cond & (df[left] == other[right])
    return df.join(other, cond, "left").drop(*[other[right] for _, right in pairs])

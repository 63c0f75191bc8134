"""Exact operators whose work stays spread out when one key holds a large part of the rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


# Input bytes for each partition of an exchange whose number of partitions is given, and which Spark therefore never changes.
BYTES_A_PARTITION = 16 << 20
_UNKNOWN_SIZE = 1 << 62  # what Spark takes a source without a size for


def spread(df: DataFrame, buckets: int | None = None) -> int:
    """Number of partitions for an exchange of the rows: the session's, more of them where the tables read are large.

    So a task's share of the rows stays the same while the tables grow. The sizes are those that Spark plans with; nothing is read.
    """
    if buckets:
        return buckets
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    wanted = -(-sum(s for s in sizes if s < _UNKNOWN_SIZE) // BYTES_A_PARTITION)
    return max(wanted, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


# Stands for NULL in a key that is compared; rows with a NULL key add nothing to it.
_NOTHING = {T.StringType: "", T.BooleanType: False, T.DateType: dt.date(1970, 1, 1), T.TimestampType: dt.datetime(1970, 1, 1)}


def never_null(df: DataFrame, key: str) -> Column:
    """A key that can be compared and moved without Spark asking whether it is NULL."""
    kind = df.schema[key].dataType
    if isinstance(kind, T.NumericType):
        return F.coalesce(F.col(key), F.lit(0).cast(kind))
    if type(kind) in _NOTHING:
        return F.coalesce(F.col(key), F.lit(_NOTHING[type(kind)]).cast(kind))
    return F.struct(key)


# Where rows lie that ``place`` moved: their key, never NULL, and a sub-key.
PLACE = ("_place_key", "_place_sub")


def place(df: DataFrame, key: str, by: list[str], buckets: int | None = None) -> DataFrame:
    """``df`` moved by ``key`` and a sub-key from a hash of the columns ``by``, both kept as ``PLACE``; a hot key is spread (``spread``).

    Rows equal in ``by``, which must hold the key, lie together. Grouping by ``PLACE`` and more needs no other exchange, nor do totals of
    the key (``attach_group_totals``).
    """
    n = spread(df, buckets)
    where = dict(zip(PLACE, (never_null(df, key), F.pmod(F.xxhash64(*by), F.lit(n)).cast("int"))))
    return df.repartition(n, *where.values()).withColumns(where)


def placed(df: DataFrame) -> tuple[str, ...]:
    """``PLACE`` if the rows still have it."""
    return PLACE if set(PLACE) <= set(df.columns) else ()


def attach_group_totals(
    df: DataFrame, keys: list[str], sums: dict[str, Column], buckets: int | None = None, at: tuple[str, ...] = ()
) -> DataFrame:
    """Add sums over all rows with the same keys to every row, each under its name in ``sums``.

    A window over the keys would sort a hot key in one task. Here each row gets a sub-key from a hash of the whole row and is
    moved once, by key and sub-key, so a hot key is spread over as many tasks as there are partitions (``spread``). The same
    exchange serves both uses of the rows: sums per (key, sub-key) are taken where the rows lie, added up per
    key over at most ``buckets`` narrow rows, and joined back. NULL keys get NULL. Equal rows share a
    sub-key: aggregate copies first, or leave them to the skew join. ``at``: the ``PLACE`` of rows that lie by their only key already;
    they are not moved again, and share their exchange if ``sums`` need all that it carries.
    """
    # The sub-key is computed above the exchange from all columns and no key can be NULL, so Spark neither prunes columns
    # nor pushes a filter into one of the uses, which would make them two exchanges.
    if at:
        *names, subname = at
        rows = df
    else:
        n = spread(df, buckets)
        names, subname = [f"_key{i}" for i in range(len(keys))], "_sub"
        sub = F.pmod(F.xxhash64(*df.columns), F.lit(n)).cast("int")
        moved = df.withColumns({name: never_null(df, k) for name, k in zip(names, keys)}).repartition(n, *names, sub)
        rows = moved.withColumn(subname, sub)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    per_sub = rows.groupBy(*names, subname).agg(*[F.sum(F.when(known, value)).alias(f"_part_{out}") for out, value in sums.items()])
    by_key = Window.partitionBy(*names)
    totals = per_sub.select(
        *[F.col(name).alias(f"{name}_") for name in names],
        F.col(subname).alias(f"{subname}_"),
        *[F.sum(f"_part_{out}").over(by_key).alias(f"_total_{out}") for out in sums],
    )
    same = F.col(subname) == F.col(f"{subname}_")
    for name in names:
        same = same & (F.col(name) == F.col(f"{name}_"))
    joined = rows.join(totals, same, "left")
    return joined.select(*df.columns, *[F.when(known, F.col(f"_total_{out}")).alias(out) for out in sums])


def attach_group_total(
    df: DataFrame, keys: list[str], value: str, out: str, buckets: int | None = None, at: tuple[str, ...] = ()
) -> DataFrame:
    """``attach_group_totals`` of one column."""
    return attach_group_totals(df, keys, {out: F.col(value)}, buckets, at)


def collapse_copies(df: DataFrame, count_col: str = "copies", negative: Column | None = None) -> DataFrame:
    """One row per distinct row with its number of copies; copies are combined before the shuffle.

    Rows that satisfy ``negative`` get their number with a minus sign. A filter on that
    sign stays above this aggregate, where a filter on the row itself would be pushed
    below it; so several uses of the result share one exchange.
    """
    one = F.lit(1) if negative is None else F.when(negative, -1).otherwise(1)
    return df.groupBy(*df.columns).agg(F.sum(one).alias(count_col))


def chunk_copies(df: DataFrame, count_col: str = "copies", chunk: int = 100_000) -> DataFrame:
    """Cut large copy counts into chunks, numbered in ``copy_chunk``, so a sort can spread them."""
    last = F.floor((F.col(count_col) - 1) / chunk).cast("int")
    size = F.least(F.lit(chunk), F.col(count_col) - F.col("copy_chunk").cast("bigint") * chunk)
    return df.withColumn("copy_chunk", F.explode(F.sequence(F.lit(0), last))).withColumn(count_col, size)


def expand_copies(df: DataFrame, count_col: str = "copies") -> DataFrame:
    """Undo ``collapse_copies``: emit every copy again, a bounded chunk at a time."""
    chunked = df if "copy_chunk" in df.columns else chunk_copies(df, count_col)
    one = F.explode(F.array_repeat(F.lit(1).cast("tinyint"), F.col(count_col).cast("int")))
    return chunked.withColumn("_copy", one).drop("_copy", count_col, "copy_chunk")

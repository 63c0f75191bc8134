"""Grouped sums, conditional metrics, scopes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from retailgrain.functions.numbers import exact_sum, sum_or_zero
from retailgrain.operators.filters import drop_null_keys


def group_sums(
    df: DataFrame, keys: Sequence[str], metrics: Sequence[str], null_keys: bool = False
) -> DataFrame:
    """Sums per key; NULL sums become 0 and rows with a NULL key are left out unless asked for."""
    rows = df if null_keys or not keys else drop_null_keys(df, list(keys))
    return rows.groupBy(*keys).agg(*[sum_or_zero(F.col(m)).alias(m) for m in metrics])


def group_count(df: DataFrame, keys: Sequence[str], counted: str, out: str = "line_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(counted).alias(out))


def money_sum(value: Column) -> Column:
    """Exact money sum, returned as a double, 0 without amounts; an error where amounts do not fit (see ``exact_sum``)."""
    return F.coalesce(exact_sum(value), F.lit(0)).cast("double")


def conditional_sums(conditions: Mapping[str, Column], value: Column) -> list[Column]:
    """One sum per condition: the value where it holds, else 0."""
    return [F.sum(F.when(cond, value).otherwise(F.lit(0))).alias(name) for name, cond in conditions.items()]


@dataclass(frozen=True)
class Scope:
    """One section of a report: which rows it lists, under which key, and which of them it sums.

    Rows that are listed but not summed (``summed``) add their key with zeros.
    """

    name: str
    listed: Column
    key: Column | None = None
    subkey: Column | None = None
    summed: Column | None = None

    def tag(self) -> Column:
        listed = self.listed
        for k in (self.key, self.subkey):
            if k is not None:
                listed = listed & k.isNotNull()
        none = F.lit(None).cast("string")
        counts = F.lit(True) if self.summed is None else F.coalesce(self.summed, F.lit(False))
        return F.when(
            listed,
            F.struct(
                F.lit(self.name).alias("section"),
                (none if self.key is None else self.key.cast("string")).alias("key"),
                (none if self.subkey is None else self.subkey.cast("string")).alias("subkey"),
                counts.alias("counts"),
            ),
        )


def scope_sums(df: DataFrame, scopes: Sequence[Scope], metrics: Sequence[str]) -> DataFrame:
    """Many overlapping aggregates in one pass: (section, key, subkey) and the sums.

    Every row is tagged with the scopes it belongs to and one grouped sum serves
    them all; sums are combined before the shuffle, so a large section is no hot spot.
    """
    tags = F.explode(F.array_compact(F.array(*[s.tag() for s in scopes])))
    exploded = df.select(*metrics, tags.alias("_tag"))
    keys = [F.col(f"_tag.{k}").alias(k) for k in ("section", "key", "subkey")]
    value = {m: F.when(F.col("_tag.counts"), F.col(m)) for m in metrics}
    return exploded.groupBy(*keys).agg(*[sum_or_zero(v).alias(m) for m, v in value.items()])

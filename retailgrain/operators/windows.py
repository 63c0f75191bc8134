"""Order weights, shares, and changes between periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from retailgrain.functions.numbers import half_even_int, safe_ratio_pct
from retailgrain.operators.joins import with_total
from retailgrain.operators.skew import PLACE, attach_group_total

# Keeps a sum of fractions that should be a whole number from truncating below it.
WEIGHT_EPSILON = 1e-9
_HALF = 1 << 31


def group_row_count(df: DataFrame, key: str, out: str = "order_rows", buckets: int | None = None) -> DataFrame:
    """Number of rows with the same key on every row; NULL for a NULL key. Rows should be distinct."""
    return attach_group_total(df.withColumn("_one", F.lit(1).cast("bigint")), [key], "_one", out, buckets).drop("_one")


def order_weight(df: DataFrame, order: str, out: str = "order_weight", buckets: int | None = None) -> DataFrame:
    """``1 / rows of the same order``, so an order's rows add up to one purchase; 0 without an order number."""
    counted = group_row_count(df.drop(*PLACE), order, "_rows", buckets)
    return counted.withColumn(out, F.coalesce(F.lit(1.0) / F.col("_rows"), F.lit(0.0))).drop("_rows")


def weigh_order_groups(
    df: DataFrame, order: str, rows: str = "row_count", buckets: int | None = None, at: tuple[str, ...] = ()
) -> DataFrame:
    """Order weight of rows already grouped by order and report dimensions, or finer.

    Adds ``whole_orders`` (1 where the group holds the complete order) and
    ``part_weight`` (the fraction otherwise), also as ``part_units`` for ``summed_units``. Whole orders add up exactly as
    integers, only split orders need fractions. ``at``: see ``attach_group_totals``.
    """
    total = attach_group_total(df, [order], rows, "_order_rows", buckets, at)
    complete = F.col(rows) == F.col("_order_rows")
    fraction = F.col(rows) / F.col("_order_rows")
    return total.withColumns({
        "whole_orders": F.coalesce(complete.cast("bigint"), F.lit(0).cast("bigint")),
        "part_weight": F.coalesce(F.when(~complete, fraction), F.lit(0.0)),
        "part_units": F.coalesce(F.when(~complete, F.expr(f"{1 << 62}L div _order_rows") * F.col(rows)), F.lit(0).cast("bigint")),
    }).drop("_order_rows")


def summed_units(units: Column) -> tuple[Column, Column]:
    """Whole number and fraction of a sum of ``part_units``, shares of 2**62 rounded down.

    Upper and lower bits add up as 64-bit integers, so the sum does not depend on the order of rows and falls short by
    less than 2**-62 for each of them.
    """
    low = F.sum(units.bitwiseAND(F.lit(_HALF - 1)))
    high = F.sum(F.shiftright(units, 31)) + F.shiftright(low, 31)
    return F.shiftright(high, 31), high.bitwiseAND(F.lit(_HALF - 1)) / float(_HALF) + low.bitwiseAND(F.lit(_HALF - 1)) / float(_HALF * _HALF)


def truncated_weight(whole: Column, part: Column) -> Column:
    return whole + F.floor(part + F.lit(WEIGHT_EPSILON)).cast("bigint")


def share_of_total(df: DataFrame, total: DataFrame, metrics: Sequence[str], suffix: str = "_total_pct") -> DataFrame:
    """Each metric as a rounded percentage of the one-row total."""
    joined = with_total(df, total, metrics)
    shares = {m + suffix: safe_ratio_pct(F.col(m), F.col(f"_total.{m}")) for m in metrics}
    return joined.withColumns(shares).drop("_total")


def diff_vs_total(df: DataFrame, total: DataFrame, ratios: Sequence[str], suffix: str = "_vs_total") -> DataFrame:
    """Each ratio minus the ratio of the one-row total, in points."""
    joined = with_total(df, total, ratios)
    diffs = {r + suffix: half_even_int(F.col(r) - F.col(f"_total.{r}")) for r in ratios}
    return joined.withColumns(diffs).drop("_total")


def period_change(
    df: DataFrame, series: Sequence[str], period: str, value: str = "value", out: str = "pct_change"
) -> DataFrame:
    """Rounded % change against the previous period of the same series.

    NULL for the first period, 0 where the previous value is 0. A series holds one
    row per period, so a window partition is as long as the calendar.
    """
    previous = F.lag(value).over(Window.partitionBy(*series).orderBy(period))
    change = safe_ratio_pct(F.col(value) - previous, previous)
    return df.withColumn(out, F.when(previous.isNotNull(), change))


def pair_week_weekend(weeks: DataFrame, weekends: DataFrame, key: str, metrics: Sequence[str]) -> DataFrame:
    """Put each weekend's metrics beside its week's, 0 for a week without weekend rows."""
    right = weekends.select(key, *[F.col(m).alias(f"weekend_{m}") for m in metrics])
    return weeks.join(right, key, "left").na.fill(0, subset=[f"weekend_{m}" for m in metrics])

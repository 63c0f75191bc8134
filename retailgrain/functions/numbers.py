"""Rounding, ratios and exact sums."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def half_even_int(value: Column) -> Column:
    """Round half to even and return a bigint (2.5 -> 2, 3.5 -> 4, -2.5 -> -2)."""
    return F.rint(value.cast("double")).cast("bigint")


def trunc_int(value: Column) -> Column:
    """Drop the fraction, toward zero."""
    return value.cast("bigint")


def null_default(value: Column, default) -> Column:
    return F.coalesce(value, default if isinstance(default, Column) else F.lit(default))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` rounded half-even; 0 for a zero or missing divisor."""
    ratio = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return F.coalesce(half_even_int(ratio), F.lit(0).cast("bigint"))


def safe_ratio_pct(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator * 100`` rounded half-even; 0 for a zero or missing divisor."""
    ratio = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return F.coalesce(half_even_int(ratio * 100), F.lit(0).cast("bigint"))


def sum_or_zero(value: Column) -> Column:
    """Sum that skips NULLs and gives 0 where every value is NULL."""
    return F.coalesce(F.sum(value), F.lit(0))


MICRO = 1_000_000
# Beyond this an amount's whole part has no 64-bit number.
LARGEST_AMOUNT = 9e18


def fits(amount: Column) -> Column:
    """Whether an amount can be added up exactly: neither NaN nor infinite nor beyond 64 bits; NULL for NULL."""
    return F.abs(amount) < F.lit(LARGEST_AMOUNT)


def amount_parts(amount: Column) -> tuple[Column, Column, Column]:
    """Three sums that hold an exact total: whole units, millionths, amounts that do not fit.

    Plain 64-bit additions, so partial sums are cheap, do not depend on the order of rows, and can be added up again
    with ``F.sum``. A sum of whole units beyond 64 bits fails.
    """
    good, whole = fits(amount), amount.cast("bigint")
    # The difference to the whole part is exact; it is rounded to millionths, half away from zero, as a decimal cast does.
    rest = (amount - whole) * MICRO
    rest = F.when(amount < 0, -F.floor(F.lit(0.5) - rest)).otherwise(F.floor(rest + F.lit(0.5)))
    return (
        F.sum(F.when(good, whole)),
        F.sum(F.when(good, rest.cast("bigint"))),
        F.count_if(amount.isNotNull() & ~F.coalesce(good, F.lit(False))),
    )


def total_of_parts(whole: Column, rest: Column, unfit: Column) -> Column:
    """The total as a decimal(38,6); NULL without an amount; an error where amounts did not fit."""
    carried = (whole.cast("decimal(20,0)") * F.lit(MICRO).cast("decimal(7,0)") + rest.cast("decimal(20,0)")).cast("decimal(38,0)")
    total = (carried * F.lit("0.000001").cast("decimal(6,6)")).cast("decimal(38,6)")
    message = F.concat(unfit.cast("string"), F.lit(" amounts are not finite or too large to add up exactly"))
    return F.when(unfit > 0, F.raise_error(message).cast("decimal(38,6)")).otherwise(total)


def exact_sum(amount: Column) -> Column:
    """Exact sum of amounts to six digits, as a decimal(38,6): see ``amount_parts`` and ``total_of_parts``."""
    return total_of_parts(*amount_parts(amount))

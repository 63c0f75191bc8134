"""Year-over-year metric families: net change, % change, conversion, basket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from retailgrain.functions.numbers import half_even_int, safe_ratio, safe_ratio_pct

YEARS = ("year0_minus_2", "year0_minus_1", "year0")
MEASURES = ("stotal", "people_in", "checkout")
SUM_METRICS = tuple(f"{year}_{measure}" for measure in MEASURES for year in YEARS)
CONVERSIONS = tuple(f"{year}_conversion" for year in YEARS)
BASKETS = tuple(f"{year}_basket" for year in YEARS)
RATIO_METRICS = CONVERSIONS + BASKETS
DERIVED_METRICS = (
    *(f"{m}_{kind}" for m in MEASURES for kind in ("net", "pct")),
    *CONVERSIONS, "conversion_net", "conversion_pct",
    *BASKETS, "basket_net", "basket_pct",
)


def net(measure: str) -> Column:
    return half_even_int(F.col(f"year0_{measure}") - F.col(f"year0_minus_1_{measure}"))


def pct(measure: str) -> Column:
    now, before = F.col(f"year0_{measure}"), F.col(f"year0_minus_1_{measure}")
    return safe_ratio_pct(now - before, before)


def with_net(df: DataFrame) -> DataFrame:
    return df.withColumns({f"{m}_net": net(m) for m in MEASURES})


def with_pct(df: DataFrame) -> DataFrame:
    return df.withColumns({f"{m}_pct": pct(m) for m in MEASURES})


def conversion(year: str, prefix: str = "") -> Column:
    """Checkouts per hundred visitors."""
    return safe_ratio_pct(F.col(f"{prefix}{year}_checkout"), F.col(f"{prefix}{year}_people_in"))


def basket(year: str, prefix: str = "") -> Column:
    """Revenue per checkout."""
    return safe_ratio(F.col(f"{prefix}{year}_stotal"), F.col(f"{prefix}{year}_checkout"))


def with_conversion(df: DataFrame) -> DataFrame:
    return df.withColumns({f"{y}_conversion": conversion(y) for y in YEARS})


def with_basket(df: DataFrame) -> DataFrame:
    return df.withColumns({f"{y}_basket": basket(y) for y in YEARS})


def with_ratio_delta(df: DataFrame, ratio: str) -> DataFrame:
    """Net and % change of an already rounded ratio."""
    return df.withColumns({f"{ratio}_net": net(ratio), f"{ratio}_pct": pct(ratio)})


def derive_yoy(df: DataFrame) -> DataFrame:
    """All 16 derived columns from the 9 sums. Ratios are always taken from sums, never summed."""
    out = with_basket(with_conversion(with_pct(with_net(df))))
    return with_ratio_delta(with_ratio_delta(out, "conversion"), "basket")

"""Year-over-year derived metrics, by region and channel of all months."""

from __future__ import annotations

from pyspark.sql import functions as F

from retailgrain.checks import standins as s
from retailgrain.checks.aggregates import SUMS
from retailgrain.checks.registry import check
from retailgrain.operators import yoy
from retailgrain.operators.aggregates import group_sums
from retailgrain.plans.yoy_sales import fact_sums
from retailgrain.plans.yoy_sales import max_date as last_day

KEYS = ["region", "shop_name", "channel"]


def _sums(spark, sf):
    """Sums per region, shop and channel; some shops had no orders in some years."""
    return group_sums(fact_sums(s.facts(spark, sf)), KEYS, SUMS)


def _sql(*columns: str) -> str:
    keys = ", ".join(KEYS)
    present = " AND ".join(f"{k} IS NOT NULL" for k in KEYS)
    return f"""
WITH {s.FACT_SQL},
sums AS (SELECT {keys}, {s.sums_sql()} FROM fact WHERE {present} GROUP BY {keys}),
derived AS ({s.derived_sql("sums", keys)})
SELECT {keys}, {", ".join(columns)} FROM derived"""


_NETS = [f"{m}_net" for m in yoy.MEASURES]
_PCTS = [f"{m}_pct" for m in yoy.MEASURES]


@check("yoy_net", _sql(*_NETS))
def yoy_net(spark, sf):
    return yoy.with_net(_sums(spark, sf)).select(*KEYS, *_NETS)


@check("yoy_pct", _sql(*_PCTS))
def yoy_pct(spark, sf):
    return yoy.with_pct(_sums(spark, sf)).select(*KEYS, *_PCTS)


@check("yoy_conversion", _sql(*yoy.CONVERSIONS))
def yoy_conversion(spark, sf):
    return yoy.with_conversion(_sums(spark, sf)).select(*KEYS, *yoy.CONVERSIONS)


@check("yoy_conversion_delta", _sql("conversion_net", "conversion_pct"))
def yoy_conversion_delta(spark, sf):
    rounded = yoy.with_conversion(_sums(spark, sf))
    return yoy.with_ratio_delta(rounded, "conversion").select(*KEYS, "conversion_net", "conversion_pct")


@check("yoy_basket", _sql(*yoy.BASKETS))
def yoy_basket(spark, sf):
    return yoy.with_basket(_sums(spark, sf)).select(*KEYS, *yoy.BASKETS)


@check("yoy_basket_delta", _sql("basket_net", "basket_pct"))
def yoy_basket_delta(spark, sf):
    rounded = yoy.with_basket(_sums(spark, sf))
    return yoy.with_ratio_delta(rounded, "basket").select(*KEYS, "basket_net", "basket_pct")


@check("max_date", f"WITH {s.FACTS_SQL} SELECT CAST(max(full_date) AS VARCHAR) AS full_date FROM facts")
def max_date(spark, sf):
    return last_day(s.facts(spark, sf)).select(F.col("full_date").cast("string").alias("full_date"))

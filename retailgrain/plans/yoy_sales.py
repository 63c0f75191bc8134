"""Year-over-year sales: in-month and to-date sections with derived metrics and shares."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from retailgrain.functions import city_group, exact_sum, safe_ratio_pct, sum_or_zero
from retailgrain.operators.aggregates import Scope, scope_sums
from retailgrain.operators.reshape import metrics_to_rows
from retailgrain.operators.yoy import (
    DERIVED_METRICS,
    RATIO_METRICS,
    SUM_METRICS,
    YEARS,
    basket,
    conversion,
    derive_yoy,
)
from retailgrain.rules.fixed_values import CITY_GROUPS

FACT_KEYS = ("month", "region", "company", "channel", "shop_name")
SHARE_SECTION = "shops_by_region"
SHARE_METRICS = tuple(f"{m}_total_pct" for m in SUM_METRICS)
DIFF_METRICS = tuple(f"{m}_vs_total" for m in RATIO_METRICS)


@dataclass(frozen=True)
class SalesScopes:
    """The codes the sections are cut by."""

    company: str
    month: int
    shop_regions: tuple[str, ...]
    online_region: str = "E-prekyba"
    b2b_region: str = "B2B"
    other_regions: tuple[str, ...] = ("B2B",)
    city_groups: tuple[tuple[str, str], ...] = CITY_GROUPS


def fact_sums(facts: DataFrame) -> DataFrame:
    """Nine sums per month, region, company, channel and shop.

    Revenue and visitors are added up exactly; only the sum is rounded, half away from zero. Amounts that
    cannot be added up exactly (NaN, infinite, beyond 64 bits) fail the query.
    """

    def total(metric: str):
        if metric.endswith("checkout"):
            value = F.sum(metric)
        else:
            value = F.round(exact_sum(F.col(metric)), 0)
        return value.cast("bigint").alias(metric)

    return facts.groupBy(*FACT_KEYS).agg(*[total(m) for m in SUM_METRICS])


def sales_scopes(s: SalesScopes) -> list[Scope]:
    month = F.col("month") == s.month
    shops = F.col("region").isin(*s.shop_regions)
    company = F.col("company") == s.company
    keyed = F.col("region").isNotNull() & F.col("channel").isNotNull()
    main = month & company & keyed
    online = F.col("region") == s.online_region
    region, channel = F.col("region"), F.col("channel")
    return [
        Scope("region_channel", main, region, channel),
        Scope("shops_in_month", main & shops),
        Scope("shops_to_date", shops & F.col("channel").isNotNull()),
        Scope("online", main & online, channel),
        Scope("online_to_date", online),
        Scope("b2b", main & (F.col("region") == s.b2b_region)),
        Scope("other_channels_to_date", F.col("region").isin(*s.other_regions)),
        Scope("group_in_month", main),
        Scope("group_to_date", company),
        Scope(SHARE_SECTION, main & shops, region),
        # Lists every channel of the month, sums the shops' rows only.
        Scope("shops_by_channel", main, channel, summed=shops),
        Scope("city_groups", shops & month & F.col("shop_name").isNotNull(), F.col("city_group")),
    ]


def yoy_sections(fact: DataFrame, scopes: SalesScopes) -> DataFrame:
    """All sections as (section, key, subkey), 9 sums, 16 derived columns, shares and differences.

    The fact is first reduced to the columns the sections are cut by. Shares and
    differences are filled for the shops' regions and NULL elsewhere; their total is
    a window over that section, which holds one row per listed shop region.
    """
    cut = fact.withColumn("city_group", city_group(F.col("shop_name"), scopes.city_groups))
    named = F.when(F.col("shop_name").isNotNull(), F.lit("")).alias("shop_name")
    reduced = cut.groupBy("month", "region", "company", "channel", "city_group", named).agg(
        *[sum_or_zero(F.col(m)).alias(m) for m in SUM_METRICS]
    )
    sections = derive_yoy(scope_sums(reduced, sales_scopes(scopes), SUM_METRICS))
    return _with_shares(sections)


def _with_shares(sections: DataFrame) -> DataFrame:
    shared = F.col("section") == SHARE_SECTION
    regions = Window.partitionBy("section")
    out = sections.withColumns({f"_t_{m}": F.sum(F.when(shared, F.col(m))).over(regions) for m in SUM_METRICS})
    added = {f"{m}_total_pct": safe_ratio_pct(F.col(m), F.col(f"_t_{m}")) for m in SUM_METRICS}
    added |= {f"{y}_conversion_vs_total": F.col(f"{y}_conversion") - conversion(y, "_t_") for y in YEARS}
    added |= {f"{y}_basket_vs_total": F.col(f"{y}_basket") - basket(y, "_t_") for y in YEARS}
    return out.withColumns({name: F.when(shared, value) for name, value in added.items()}).drop(
        *[f"_t_{m}" for m in SUM_METRICS]
    )


def yoy_bundle(fact: DataFrame, scopes: SalesScopes) -> DataFrame:
    """All sections as one long table (section, key, subkey, metric, value).

    The section of shop regions lists percentages and differences only, all others the
    sums and their derived metrics.
    """
    metrics = [*SUM_METRICS, *DERIVED_METRICS, *SHARE_METRICS, *DIFF_METRICS]
    rows = metrics_to_rows(yoy_sections(fact, scopes), ["section", "key", "subkey"], metrics)
    percent = F.col("metric").endswith("_pct") | F.col("metric").endswith("_vs_total")
    return rows.where(F.col("value").isNotNull() & ((F.col("section") != SHARE_SECTION) | percent))


def max_date(facts: DataFrame) -> DataFrame:
    """The last day the facts hold."""
    return facts.agg(F.max("full_date").alias("full_date"))


def yoy_report(facts: DataFrame, scopes: SalesScopes) -> DataFrame:
    """The complete sales report, with the last day of the data on every row."""
    return yoy_bundle(fact_sums(facts), scopes).withColumn("data_until", max_date(facts).scalar())

"""Weekly and weekend order metrics with the change against the previous period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from retailgrain.functions import fix_address_spacing, iso_week, metric_condition, shop_condition, str_normalize
from retailgrain.functions import week_label, weekend_flag, weekend_label
from retailgrain.functions.dates import FRIDAY
from retailgrain.functions.matching import pickup_condition
from retailgrain.operators.aggregates import conditional_sums
from retailgrain.operators.filters import all_present
from retailgrain.operators.rule_joins import shop_pairs_by_join
from retailgrain.operators.windows import period_change, truncated_weight, weigh_order_groups
from retailgrain.rules.fixed_values import PICKUP_DELIVERIES
from retailgrain.rules.tables import MetricRule, ShopRule
from retailgrain.session import stored

DETAIL_DIMS = ["week_start", "is_weekend", "address", "order_status", "channel", "delivery"]


def dimension_groups(lines: DataFrame, first_weekend_day: int = FRIDAY, keys: Sequence[str] = ()) -> DataFrame:
    """Lines combined per order and report dimensions, and per further keys."""
    dims = lines.withColumns({
        "address": fix_address_spacing(F.col("address")),
        "is_weekend": weekend_flag(F.col("order_date"), first_weekend_day),
    })
    return dims.groupBy(*keys, "order_no", *DETAIL_DIMS).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("line_count").alias("line_count"),
        all_present(DETAIL_DIMS).alias("complete"),
    )


def order_groups(lines: DataFrame, first_weekend_day: int = FRIDAY) -> DataFrame:
    """``dimension_groups`` with order weights."""
    return weigh_order_groups(dimension_groups(lines, first_weekend_day), "order_no")


def complete_groups(groups: DataFrame, total: str) -> DataFrame:
    """Groups without a NULL dimension. ``total``: a column of what the orders' totals gave, never negative or NULL without an order.

    A filter on the groups alone would go below the exchange that they share with the totals, which would then be made twice.
    """
    return groups.where(F.when(F.col("complete"), F.coalesce(F.col(total), F.lit(0))) >= 0)


def detail_dims(groups: DataFrame) -> DataFrame:
    """Line count and truncated order weight per dimensions; rows with a NULL dimension are left out."""
    detail = complete_groups(groups, "whole_orders").groupBy(*DETAIL_DIMS).agg(
        F.sum("line_count").alias("line_count"),
        F.sum("whole_orders").alias("_whole"),
        F.sum("part_weight").alias("_part"),
    )
    return detail.withColumn("orders", truncated_weight(F.col("_whole"), F.col("_part"))).drop("_whole", "_part")


def _conditions(
    metric_rules: Sequence[MetricRule], shop_rules: Sequence[ShopRule], pickup: Sequence[str]
) -> dict[str, Column]:
    conditions = {rule.metric: metric_condition(rule) for rule in metric_rules}
    for rule in shop_rules:
        at_shop = shop_condition(F.col("_address"), rule, is_normalized=True)
        conditions[rule.label] = pickup_condition(F.col("delivery"), pickup) & at_shop
    return conditions


def weekly_metrics(
    lines: DataFrame,
    metric_rules: Sequence[MetricRule],
    shop_rules: Sequence[ShopRule] = (),
    pickup_deliveries: Sequence[str] = PICKUP_DELIVERIES,
    counting: str = "group",
    first_weekend_day: int = FRIDAY,
) -> DataFrame:
    """Long form (week_start, iso_week, label, period_kind, metric, value).

    ``counting='group'`` truncates the order weight per detailed group before
    adding up; ``'distinct'`` counts distinct orders instead.
    """
    conditions = _conditions(metric_rules, shop_rules, pickup_deliveries)
    names = list(conditions)
    numbered = {f"m{i}": conditions[name] for i, name in enumerate(names)}
    groups = order_groups(lines, first_weekend_day)
    if counting == "group":
        sums = _period_sums(detail_dims(groups), numbered)
    elif counting == "distinct":
        rows = groups.where(F.col("complete") & F.col("order_no").isNotNull())
        rows = rows.withColumn("_address", str_normalize(F.col("address")))
        both = rows.withColumn("period_kind", F.explode(F.lit(["week", "weekend"])))
        belongs = (F.col("period_kind") == "week") | F.col("is_weekend")
        per_order = both.groupBy("week_start", "period_kind", "order_no").agg(
            *[F.max(belongs & F.coalesce(c, F.lit(False))).alias(m) for m, c in numbered.items()]
        )
        sums = per_order.groupBy("week_start", "period_kind").agg(*[F.count_if(F.col(m)).alias(m) for m in numbered])
    else:
        raise ValueError(f"unknown counting {counting!r}")
    return _metric_rows(sums, names, first_weekend_day)


def metrics_of_detail(
    detail: DataFrame,
    metric_rules: Sequence[MetricRule],
    shop_rules: Sequence[ShopRule] = (),
    pickup_deliveries: Sequence[str] = PICKUP_DELIVERIES,
    first_weekend_day: int = FRIDAY,
) -> DataFrame:
    """``weekly_metrics`` from the rows of ``detail_dims``."""
    conditions = _conditions(metric_rules, shop_rules, pickup_deliveries)
    numbered = {f"m{i}": c for i, c in enumerate(conditions.values())}
    return _metric_rows(_period_sums(detail, numbered), list(conditions), first_weekend_day)


def _period_sums(detail: DataFrame, numbered: dict[str, Column]) -> DataFrame:
    rows = detail.withColumn("_address", str_normalize(F.col("address")))
    per_week = rows.groupBy("week_start", "is_weekend").agg(*conditional_sums(numbered, F.col("orders")))
    # The weekend rows are part of the week, so both follow from one grouped pass.
    both = per_week.withColumn("period_kind", F.explode(F.lit(["week", "weekend"])))
    belongs = (F.col("period_kind") == "week") | F.col("is_weekend")
    return both.groupBy("week_start", "period_kind").agg(
        *[F.sum(F.when(belongs, F.col(m)).otherwise(0)).alias(m) for m in numbered]
    )


def _metric_rows(sums: DataFrame, names: Sequence[str], first_weekend_day: int) -> DataFrame:
    numbered = [f"m{i}" for i in range(len(names))]
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(m).alias("value")) for n, m in zip(names, numbered)])
    return sums.select(
        "week_start",
        iso_week(F.col("week_start")).alias("iso_week"),
        _period_label(first_weekend_day).alias("label"),
        "period_kind",
        F.inline(pairs),
    )


def _period_label(first_weekend_day: int) -> Column:
    return F.when(F.col("period_kind") == "week", week_label(F.col("week_start"))).otherwise(
        weekend_label(F.col("week_start"), first_weekend_day)
    )


def weekly_shop_metrics(
    lines: DataFrame,
    shop_rules: DataFrame,
    pickup_deliveries: Sequence[str] = PICKUP_DELIVERIES,
    first_weekend_day: int = FRIDAY,
) -> DataFrame:
    """The shop part of ``weekly_metrics`` for a rule table of any length, matched by equi-joins: the same rows and columns, zeros too."""
    # Several uses follow, each of other columns and rows: without a stored step each would make all lines again.
    detail = stored(detail_dims(order_groups(lines, first_weekend_day)), "weekly-detail")
    picked_up = detail.where(pickup_condition(F.col("delivery"), pickup_deliveries))
    per_address = picked_up.groupBy("week_start", "is_weekend", str_normalize(F.col("address")).alias("subject")).agg(
        F.sum("orders").alias("orders")
    )
    labels = shop_rules.select("ordinal", F.concat("address", F.lit(", "), "city").alias("metric"))
    # Texts are matched once each; the sums per address are what joins the pairs.
    pairs = shop_pairs_by_join(per_address, "subject", shop_rules).join(labels, "ordinal")
    kinds = F.when(F.col("is_weekend"), F.lit(["week", "weekend"])).otherwise(F.lit(["week"]))
    tagged = per_address.join(pairs, "subject").select("week_start", F.explode(kinds).alias("period_kind"), "metric", "orders")
    # Every shop in every week that has orders: the weeks are a short list, the rules may be many.
    weeks = detail.agg(F.sort_array(F.collect_set("week_start")).alias("weeks"))
    every = labels.select("metric", F.explode(weeks.scalar()).alias("week_start"))
    zeros = every.select("week_start", F.explode(F.lit(["week", "weekend"])).alias("period_kind"), "metric", F.lit(0).cast("bigint").alias("orders"))
    sums = tagged.unionByName(zeros).groupBy("week_start", "period_kind", "metric").agg(F.sum("orders").alias("value"))
    label = _period_label(first_weekend_day)
    return sums.select("week_start", iso_week(F.col("week_start")).alias("iso_week"), label.alias("label"), "period_kind", "metric", "value")


def week_beside_weekend(metrics: DataFrame, first_weekend_day: int = FRIDAY) -> DataFrame:
    """One row per week and metric: value and rounded % change of the week, and beside them those of its weekend.

    Changes are against the previous week and the previous weekend; NULL for the first one.
    """
    changed = period_change(metrics, ["period_kind", "metric"], "week_start")
    of = lambda kind, c: F.max(F.when(F.col("period_kind") == kind, F.col(c)))
    rows = changed.groupBy("week_start", "iso_week", "metric").agg(
        of("week", "value").alias("value"),
        of("week", "pct_change").alias("pct_change"),
        of("weekend", "value").alias("weekend_value"),
        of("weekend", "pct_change").alias("weekend_pct_change"),
    )
    labels = {"label": week_label(F.col("week_start")), "weekend_label": weekend_label(F.col("week_start"), first_weekend_day)}
    return rows.withColumns(labels)


def weekly_table(metrics: DataFrame, names: Sequence[str], period_kind: str = "week") -> DataFrame:
    """One row per week with a column per metric, in week order; the names are given, so no job looks for them."""
    rows = metrics.where(F.col("period_kind") == period_kind)
    wide = rows.groupBy("week_start", "iso_week", "label").pivot("metric", list(names)).agg(F.sum("value"))
    return wide.orderBy("week_start")


def weekly_report(lines: DataFrame, metric_rules: Sequence[MetricRule], *args, **kwargs) -> DataFrame:
    """``weekly_metrics`` plus the rounded % change against the previous period of the same kind."""
    return period_change(weekly_metrics(lines, metric_rules, *args, **kwargs), ["period_kind", "metric"], "week_start")

"""Rule lists compiled into column expressions: no join, no shuffle, no Python per row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from retailgrain.functions.text import WHITESPACE, str_contains, str_normalize
from retailgrain.rules.fixed_values import CITY_GROUPS, OTHER_CITIES, PICKUP_DELIVERIES
from retailgrain.rules.tables import BucketBound, CityRule, MetricRule, ShopRule


def normalized(text: str) -> str:
    return text.strip(WHITESPACE).lower()


def _ordered(rules: Sequence[CityRule], strategy: str) -> list[CityRule]:
    if strategy == "first":
        return sorted(rules, key=lambda r: (r.ordinal, r.city))
    if strategy == "longest":
        return sorted(rules, key=lambda r: (-len(normalized(r.pattern)), r.ordinal, r.city))
    raise ValueError(f"unknown strategy {strategy!r}")


def first_substring(
    text: Column,
    rules: Sequence[CityRule],
    default: str = OTHER_CITIES,
    strategy: str = "first",
    is_normalized: bool = False,
) -> Column:
    """Label of the first rule whose pattern occurs in the text.

    ``first`` takes the lowest ordinal, ``longest`` the longest pattern. A chain
    of generated substring tests stops at the first hit; pass a text that is
    already normalized to keep the lowering out of the branches. Equal ranks go by city;
    an empty pattern occurs in every text, a missing one in none.
    """
    subject = text if is_normalized else str_normalize(text)
    out = None
    tried: list[str] = []
    for rule in _ordered([r for r in rules if r.pattern is not None], strategy):
        pattern = normalized(rule.pattern)
        # A pattern that contains an earlier one can never be the first match.
        if any(earlier in pattern for earlier in tried):
            continue
        tried.append(pattern)
        hit = str_contains(subject, pattern)
        out = F.when(hit, F.lit(rule.city)) if out is None else out.when(hit, F.lit(rule.city))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def shop_condition(address: Column, rule: ShopRule, is_normalized: bool = False) -> Column:
    """Whether an address belongs to the shop."""
    subject = address if is_normalized else str_normalize(address)
    pattern = normalized(rule.address)
    hit = (subject == pattern) if rule.equal else str_contains(subject, pattern)
    return (hit & str_contains(subject, normalized(rule.city))) if rule.and_city else hit


def pickup_condition(delivery: Column, deliveries: Sequence[str] = PICKUP_DELIVERIES) -> Column:
    return str_normalize(delivery).isin(*deliveries)


def matched_shops(
    address: Column,
    delivery: Column,
    rules: Sequence[ShopRule],
    deliveries: Sequence[str] = PICKUP_DELIVERIES,
    is_normalized: bool = False,
) -> Column:
    """Labels of all shops a row belongs to; empty unless it is picked up in a shop."""
    labels = F.array(*[F.when(shop_condition(address, r, is_normalized), F.lit(r.label)) for r in rules])
    empty = F.array().cast("array<string>")
    return F.when(pickup_condition(delivery, deliveries), F.array_compact(labels)).otherwise(empty)


def metric_condition(rule: MetricRule) -> Column:
    """A metric rule as a never-NULL boolean over the named field."""
    if rule.op == "any":
        return F.lit(True)
    field = F.col(rule.field)
    subject = str_normalize(field) if rule.normalize else field
    if rule.op == "in":
        hit = subject.isin(*rule.values)
    elif rule.op == "contains":
        hit = reduce(lambda a, b: a | b, [str_contains(subject, v) for v in rule.values])
    else:
        raise ValueError(f"unknown op {rule.op!r}")
    return F.coalesce(hit, F.lit(False))


def bucket(value: Column, bounds: Sequence[BucketBound], other: str | None = None) -> Column:
    """Label of the range a value falls in; ``other`` (or NULL) where it falls in none."""
    out = None
    for b in sorted(bounds, key=lambda b: b.ordinal):
        inside = F.lit(True)
        if b.lower is not None:
            inside = inside & (value >= b.lower if b.lower_inclusive else value > b.lower)
        if b.upper is not None:
            inside = inside & (value <= b.upper if b.upper_inclusive else value < b.upper)
        out = F.when(inside, F.lit(b.label)) if out is None else out.when(inside, F.lit(b.label))
    return out.otherwise(F.lit(other))


def city_group(name: Column, groups=CITY_GROUPS, default: str = OTHER_CITIES) -> Column:
    """City group by a word in the shop name."""
    subject = F.lower(name)
    out = None
    for word, label in groups:
        hit = str_contains(subject, word)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(default))

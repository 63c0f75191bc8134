"""Order lines tagged with city and buckets, rolled up over nine dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from retailgrain.functions import bucket, exact_sum
from retailgrain.operators.rule_joins import tag_by_rules
from retailgrain.operators.skew import placed
from retailgrain.operators.windows import summed_units, weigh_order_groups
from retailgrain.rules.fixed_values import CUBE_COLUMNS, OTHER_CITIES, QUANTITY_OTHER
from retailgrain.rules.tables import BucketBound, CityRule

CUBE_DIMS = [
    "iso_week", "week_label", "channel", "order_status", "city", "delivery", "product",
    "price_bucket", "quantity_bucket",
]


def order_cube(
    lines: DataFrame,
    cities: Sequence[CityRule] | DataFrame,
    price_bounds: Sequence[BucketBound],
    quantity_bounds: Sequence[BucketBound],
    other_city: str = OTHER_CITIES,
    strategy: str = "first",
) -> DataFrame:
    """Mean price and sums of lines, order weight and line totals per cube cell.

    Lines get their order's weight where they lie (``order_lines``) and move once, into their cell.
    The mean is over lines, not weighted by their count. Cells with a NULL
    dimension are left out, after their lines have counted for the order.
    """
    # A line is one row of its order. The number refers to the count, and so do the lines kept: all uses of the lines need the same
    # columns and no filter reaches their exchange, which is therefore one.
    weighed = weigh_order_groups(lines.withColumn("row_count", F.when(F.col("line_count") >= 0, F.lit(1).cast("bigint"))), "order_no", at=placed(lines))
    tagged = tag_by_rules(weighed, "address", "city", cities, other_city, strategy, lines).withColumns({
        "price_bucket": bucket(F.col("price"), price_bounds),
        "quantity_bucket": bucket(F.col("line_count"), quantity_bounds, QUANTITY_OTHER),
    })
    # Exact sums are 64-bit parts; only a cell's total becomes a decimal.
    money = {"price": "price", "line_total": "total"}
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in CUBE_DIMS])
    total = {name: exact_sum(F.col(column)).cast("double") for column, name in money.items()}
    whole, part = summed_units(F.col("part_units"))
    return tagged.where(F.when(present, F.col("line_count")) >= 0).groupBy("week_start", *CUBE_DIMS).agg(
        (total["price"] / F.sum("row_count")).alias("mean_price"),
        F.sum("line_count").alias("line_count"),
        (F.sum("whole_orders") + whole + part).alias("order_weight"),
        total["total"].alias("line_total"),
    )


def to_cube_table(cube: DataFrame) -> DataFrame:
    """The cube under the warehouse table's column names and types."""
    source = [*CUBE_DIMS, "mean_price", "line_count", "order_weight", "line_total"]
    return cube.select(*[F.col(s).cast(kind).alias(name) for s, (name, kind) in zip(source, CUBE_COLUMNS)])

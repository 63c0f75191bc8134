"""The weekly order metrics over streams of order headers and order details.

Headers and details come in any order. A batch pairs its headers with all details of open orders and its details with
all their headers, so every pair is made once. An order that got lines has its old share of each report row
retracted and its new one added. Shares are kept as whole numbers (rows of orders with so many rows), so they add up and
retract exactly, and the metrics are those of ``weekly_metrics`` over everything that came.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from retailgrain.functions.dates import FRIDAY
from retailgrain.operators.filters import not_equal_keep_null
from retailgrain.operators.skew import attach_group_total
from retailgrain.operators.windows import WEIGHT_EPSILON
from retailgrain.plans.order_lines import HEADER, LINE_KEYS, delivered_headers, described, detail_rows, paired
from retailgrain.plans.weekly_orders import DETAIL_DIMS, complete_groups, dimension_groups, metrics_of_detail
from retailgrain.rules.fixed_values import PICKUP_DELIVERIES, UNPAID_STATUS
from retailgrain.rules.tables import MetricRule, ShopRule
from retailgrain.streaming.parts import PartStore

SHARE = (*DETAIL_DIMS, "order_rows")
COUNTS = ("rows", "line_count", "groups")


class OrderMetrics:
    """Open orders and weekly shares in a ``PartStore``.

    Tables: ``headers`` and ``details`` of open orders, their distinct ``lines``, ``shares`` of the report rows, and ``late``
    rows, which came after their order was closed. A batch writes what it brings, never the state; folding adds the parts up.
    Without ``close`` nothing is ever late. ``fold_after``: parts of a table before a batch folds it.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        products: DataFrame,
        deliveries: DataFrame,
        exclude_status: str | None = UNPAID_STATUS,
        first_weekend_day: int = FRIDAY,
        fold_after: int = 16,
    ):
        self.spark, self.store = spark, PartStore(spark, root)
        self.products, self.deliveries = products, deliveries
        self.exclude_status, self.first_weekend_day, self.fold_after = exclude_status, first_weekend_day, fold_after

    def run(self, headers: DataFrame, details: DataFrame, checkpoint: str) -> None:
        """Take in everything that the two streams have."""
        header = F.struct("id", "delivery_type", *HEADER)
        detail = F.struct(*details.columns)
        none = lambda df, one: F.lit(None).cast(df.select(one.alias("x")).schema["x"].dataType)
        both = headers.select(header.alias("header"), none(details, detail).alias("detail")).unionByName(
            details.select(none(headers, header).alias("header"), detail.alias("detail"))
        )
        query = both.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(self.take).start()
        query.awaitTermination()

    def take(self, rows: DataFrame, batch: int) -> None:
        """One batch of rows (header, detail), of which one is null."""
        if self.store.taken(batch):
            return
        store, seen = self.store, self.store.manifest()
        closed = seen.notes.get("closed_until")
        headers = rows.where("header is not null").select("header.*")
        late = F.lit(False) if closed is None else F.coalesce(F.col("order_date") < F.lit(closed).cast("timestamp"), F.lit(False))
        counted = F.lit(True) if self.exclude_status is None else not_equal_keep_null(F.col("order_status"), self.exclude_status)
        named = delivered_headers(headers, self.deliveries).select("*", counted.alias("counted"), late.alias("late"))
        # Written and read again, so the rest is planned by the session's settings, not the stream's.
        new_headers = store.stage("headers", named, batch)
        new_details = store.stage("details", detail_rows(rows.where("detail is not null").select("detail.*")).withColumn("batch", F.lit(batch)), batch)
        h, d = store.staged(new_headers), store.staged(new_details)
        parts = [new_headers, new_details]
        able = "counted and not late"
        pairs = paired(h.where(able), store.read("details", seen, d.schema).unionByName(d).drop("batch"), self.products).unionByName(
            paired(store.read("headers", seen, h.schema).where(able), d.drop("batch"), self.products)
        )
        new_lines = store.stage("lines", pairs.groupBy(*LINE_KEYS).agg(F.sum("_n").alias("line_count")), batch)
        fresh = store.staged(new_lines)
        touched = fresh.select("order_no").where("order_no is not null").distinct()
        before = store.read("lines", seen, fresh.schema).join(touched, "order_no", "left_semi").select(*fresh.columns)
        # A step of its own, so that its shuffle files are gone when the shares are made.
        signed = store.stage("signed", lines_by_sign(before, fresh), batch)
        parts += [new_lines, store.stage("shares", self.change(store.staged(signed)), batch)]
        store.discard(signed)
        store.commit(batch, parts)
        if any(len(store.manifest().of(p[0].table)) >= self.fold_after for p in parts):
            self.fold()

    def change(self, signed: DataFrame) -> DataFrame:
        """What the shares of orders gain by fresh lines: rows of orders with ``order_rows`` rows, lines, groups.

        Each order is weighed as it was (sign -1) and as it is (sign 1), in one pass over ``lines_by_sign``.
        """
        grouped = dimension_groups(described(signed), self.first_weekend_day, ["sign"])
        known = complete_groups(attach_group_total(grouped, ["order_no", "sign"], "row_count", "order_rows"), "order_rows")
        rows = known.select(*SHARE, *[(F.col(c) * F.col("sign")).alias(c) for c in ("row_count", "line_count")], F.col("sign").cast("bigint").alias("groups"))
        return added(rows.withColumnRenamed("row_count", "rows"))

    def detail(self) -> DataFrame:
        """The rows of ``detail_dims``: line count and truncated order weight per report row."""
        shares = added(self.store.read("shares")).where("groups > 0")
        whole, part = F.expr("rows div order_rows"), F.expr("rows % order_rows") / F.col("order_rows")
        rows = shares.groupBy(*DETAIL_DIMS).agg(
            F.sum("line_count").alias("line_count"), F.sum(F.coalesce(whole, F.lit(0))).alias("_whole"), F.sum(F.coalesce(part, F.lit(0.0))).alias("_part")
        )
        orders = F.col("_whole") + F.floor(F.col("_part") + F.lit(WEIGHT_EPSILON)).cast("bigint")
        return rows.withColumn("orders", orders).drop("_whole", "_part")

    def metrics(
        self, metric_rules: Sequence[MetricRule], shop_rules: Sequence[ShopRule] = (), pickup_deliveries: Sequence[str] = PICKUP_DELIVERIES
    ) -> DataFrame:
        """``weekly_metrics`` over all headers and details so far."""
        return metrics_of_detail(self.detail(), metric_rules, shop_rules, pickup_deliveries, self.first_weekend_day)

    def waiting(self) -> DataFrame:
        """Details whose header has not come."""
        seen = self.store.manifest()
        return self.store.read("details", seen).join(self.store.read("headers", seen).select("header_id"), "header_id", "left_anti")

    def fold(self) -> bool:
        """One part for each table; the same rows, with lines and shares added up."""
        return self.store.fold({"headers": _same, "details": _same, "lines": _known, "shares": added})

    def close(self, day: dt.date, wait_batches: int | None = None) -> bool:
        """Forget orders all of whose headers are dated before ``day``; their shares stay.

        Headers of such dates that come later, and details that have waited for a header for ``wait_batches`` batches, go to
        ``late``; so do details that come for a closed order, once they have waited. The state holds open orders only.
        """
        seen, store = self.store.manifest(), self.store
        if "headers" not in seen.schemas:
            return True
        headers, details = store.read("headers", seen), store.read("details", seen)
        order = F.coalesce("order_no", F.concat(F.lit("\0"), F.col("header_id").cast("string")))
        old = headers.groupBy(order.alias("_order")).agg(F.max("order_date").alias("_until")).where(F.col("_until") < F.lit(day)).select("_order")
        open_headers = headers.withColumn("_order", order).join(old, "_order", "left_anti").drop("_order").where("not late")
        gone = headers.join(open_headers.select("header_id"), "header_id", "left_anti").select("header_id")
        unknown = details.join(headers.select("header_id"), "header_id", "left_anti")
        overdue = unknown.where(F.lit(False) if wait_batches is None else F.col("batch") <= seen.last_batch - wait_batches)
        late_headers = headers.where("late")
        told = lambda df: df.select("header_id", F.to_json(F.struct(*df.columns)).alias("row"))
        late = told(late_headers).unionByName(told(details.join(late_headers.select("header_id"), "header_id", "left_semi"))).unionByName(told(overdue))
        kept_details = details.join(gone, "header_id", "left_anti").join(overdue.select("header_id").distinct(), "header_id", "left_anti")
        closed_orders = old.withColumnRenamed("_order", "order_no")
        folds = {
            "headers": lambda df: open_headers.select(*df.columns),
            "details": lambda df: kept_details.select(*df.columns),
            "lines": lambda df: _known(df).join(closed_orders, "order_no", "left_anti").select(*df.columns),
            "shares": added,
        }
        until = max(day.isoformat(), seen.notes.get("closed_until", ""))
        return store.fold(folds, {"closed_until": until}, {"late": late}, seen)

    def late(self) -> DataFrame:
        """Rows that came too late, as JSON, by header."""
        return self.store.read("late", schema="header_id bigint, row string")


def lines_by_sign(before: DataFrame, fresh: DataFrame) -> DataFrame:
    """Distinct lines of the touched orders as they were (sign -1) and as they are (sign 1); each stored line moves once."""
    count = F.col("line_count")
    both = before.select(*LINE_KEYS, count.alias("was"), count.alias("now")).unionByName(
        fresh.select(*LINE_KEYS, F.lit(None).cast("bigint").alias("was"), count.alias("now"))
    )
    distinct = both.groupBy(*LINE_KEYS).agg(F.sum("was").alias("was"), F.sum("now").alias("now"))
    states = F.array(*[F.struct(F.lit(sign).alias("sign"), F.col(c).alias("line_count")) for sign, c in ((-1, "was"), (1, "now"))])
    return distinct.select(*LINE_KEYS, F.inline(F.filter(states, lambda x: x["line_count"].isNotNull())))


def added(shares: DataFrame) -> DataFrame:
    return shares.groupBy(*SHARE).agg(*[F.sum(c).alias(c) for c in COUNTS]).where(" or ".join(f"{c} <> 0" for c in COUNTS))


def _known(lines: DataFrame) -> DataFrame:
    """Distinct lines of orders with a number; those without one are never touched again."""
    counted = lines.where("order_no is not null").groupBy(*LINE_KEYS).agg(F.sum("line_count").alias("line_count"))
    return counted.select(*lines.columns)


def _same(rows: DataFrame) -> DataFrame:
    return rows

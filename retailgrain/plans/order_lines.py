"""Order lines: the common base of the weekly report and the order cube."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from retailgrain.functions import iso_week, join_nullable, week_label, week_start
from retailgrain.operators.filters import date_range, not_equal_keep_null
from retailgrain.operators.projections import channel_of
from retailgrain.operators.skew import PLACE, place
from retailgrain.rules.fixed_values import UNPAID_STATUS

HEADER = ("company_id", "order_no", "order_date", "order_status", "payment_status", "street", "country", "remark")
DETAIL = ("header_id", "product_id", "supplier_article_id", "price", "guarantee")


LINE_KEYS = (*HEADER, "delivery", "product_name", "supplier_article_id", "price", "guarantee")


def delivered_headers(headers: DataFrame, deliveries: DataFrame, extra_header_columns: Sequence[str] = ()) -> DataFrame:
    """Headers with the name of their delivery method, which belongs to the header and is joined before lines multiply it."""
    wanted = headers.select(F.col("id").alias("header_id"), "delivery_type", *HEADER, *extra_header_columns)
    methods = deliveries.select(
        F.col("oxid").alias("delivery_type"),
        F.col("trade_network_id").alias("company_id"),
        F.col("descr").alias("delivery"),
    )
    return wanted.join(methods, ["delivery_type", "company_id"], "left")


def detail_rows(details: DataFrame) -> DataFrame:
    return details.select(*DETAIL, F.col("id").isNotNull().cast("bigint").alias("_n"))


def paired(delivered: DataFrame, rows: DataFrame, products: DataFrame) -> DataFrame:
    """Each detail with its header and its product's name."""
    named = products.select(F.col("id").alias("product_id"), F.col("descr").alias("product_name"))
    # Names come to the narrow details: beside the headers' columns they would take an exchange of the widest rows.
    return rows.join(named, "product_id", "left").join(delivered, "header_id")


def described(lines: DataFrame) -> DataFrame:
    """Distinct lines with the columns that the reports cut them by."""
    return lines.withColumns({
        "channel": channel_of(F.col("company_id")),
        "address": join_nullable(F.col("street"), F.col("country")),
        "product": F.coalesce("product_name", "supplier_article_id"),
        "week_start": week_start(F.col("order_date")),
        "iso_week": iso_week(F.col("order_date")),
        "week_label": week_label(F.col("order_date")),
        "line_total": F.col("price") * F.col("line_count"),
    })


def order_lines(
    headers: DataFrame,
    details: DataFrame,
    products: DataFrame,
    deliveries: DataFrame,
    start: dt.date,
    end: dt.date,
    closed: str = "left",
    exclude_status: str | None = UNPAID_STATUS,
    extra_header_columns: Sequence[str] = (),
    collapse_first: bool = False,
) -> DataFrame:
    """Distinct order lines of a date range with their number of source rows.

    The date and status filters reach the header scan, and Spark prunes the details
    by the headers left. A header with very many details is split by the skew join,
    and repeated lines of a header are combined before the grouping shuffles them. Lines lie by order (``skew.place``), so what
    counts them by order moves them no more.
    ``collapse_first`` also combines them before the join: one more shuffle, worth it
    when the details hold many copies.
    """
    wanted = date_range(headers, "order_date", start, end, closed)
    if exclude_status is not None:
        wanted = wanted.where(not_equal_keep_null(F.col("order_status"), exclude_status))
    delivered = delivered_headers(wanted, deliveries, extra_header_columns)
    rows = details.groupBy(*DETAIL).agg(F.count("id").alias("_n")) if collapse_first else detail_rows(details)
    keys = [*HEADER, *extra_header_columns, *LINE_KEYS[len(HEADER):]]
    # The join leaves a header's lines together.
    per_header = paired(delivered, rows, products).groupBy("header_id", *keys).agg(F.sum("_n").alias("_n"))
    return described(place(per_header, "order_no", keys).groupBy(*PLACE, *keys).agg(F.sum("_n").alias("line_count")))

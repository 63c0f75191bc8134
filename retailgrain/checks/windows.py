"""Order weights, shares, period changes, sorting and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from retailgrain.checks import standins as s
from retailgrain.checks.aggregates import RECON_SQL, SUMS, WEEKLY_SQL, recon
from retailgrain.checks.registry import check
from retailgrain.functions import week_start, weekend_flag
from retailgrain.operators import reshape, windows
from retailgrain.operators.aggregates import group_sums
from retailgrain.operators.yoy import RATIO_METRICS, derive_yoy
from retailgrain.plans.weekly_orders import weekly_metrics, weekly_report
from retailgrain.plans.yoy_sales import fact_sums
from retailgrain.rules.fixed_values import metric_rules


@check("win_order_weight", f"""
WITH {s.LINES_SQL}
SELECT order_no, strftime(order_date, '%Y-%m-%d') AS order_day, order_status, delivery, product, price, supplier_article_id,
  CAST(order_weight AS DOUBLE) AS order_weight FROM lines""")
def win_order_weight(spark, sf):
    weighted = windows.order_weight(s.lines(spark, sf), "order_no")
    return weighted.select(
        "order_no", F.to_date("order_date").cast("string").alias("order_day"), "order_status", "delivery", "product",
        "price", "supplier_article_id", "order_weight",
    )


def _by_region(spark, sf):
    fact = fact_sums(s.facts(spark, sf))
    regions = group_sums(fact, ["region"], SUMS)
    total = group_sums(fact.where(F.col("region").isNotNull()), [], SUMS)
    return regions, total


_REGIONS_SQL = f"""{s.FACT_SQL},
regions AS (SELECT region, {s.sums_sql()} FROM fact WHERE region IS NOT NULL GROUP BY 1),
total AS (SELECT {s.sums_sql()} FROM regions)"""


@check("win_share_of_total", f"""
WITH {_REGIONS_SQL}
SELECT region, {", ".join(f"CAST(round_even(r.{m}::DOUBLE / t.{m} * 100, 0) AS BIGINT) AS {m}_total_pct" for m in s.SUMS)}
FROM regions r, total t""")
def win_share_of_total(spark, sf):
    regions, total = _by_region(spark, sf)
    return windows.share_of_total(regions, total, SUMS).drop(*SUMS)


@check("win_diff_vs_total", f"""
WITH {_REGIONS_SQL},
r AS ({s.derived_sql("regions", "region")}), t AS ({s.derived_sql("total", "")})
SELECT region, {", ".join(f"CAST(r.{m} - t.{m} AS BIGINT) AS {m}_vs_total" for m in RATIO_METRICS)} FROM r, t""")
def win_diff_vs_total(spark, sf):
    regions, total = _by_region(spark, sf)
    compared = windows.diff_vs_total(derive_yoy(regions), derive_yoy(total), RATIO_METRICS)
    return compared.select("region", *[f"{m}_vs_total" for m in RATIO_METRICS])


CHANGE_SQL = f"""{WEEKLY_SQL},
changed AS (SELECT *, lag(value) OVER (PARTITION BY period_kind, metric ORDER BY week_start) AS previous FROM weekly)"""
PCT_CHANGE_SQL = """CASE WHEN previous IS NULL THEN NULL WHEN previous = 0 THEN 0
  ELSE CAST(round_even((value - previous)::DOUBLE / previous * 100, 0) AS BIGINT) END AS pct_change"""


@check("win_period_change", f"""
WITH {CHANGE_SQL}
SELECT CAST(week_start AS VARCHAR) AS week_start, period_kind, metric, value, {PCT_CHANGE_SQL} FROM changed""")
def win_period_change(spark, sf):
    report = weekly_report(s.lines(spark, sf), metric_rules(), s.SHOP_RULES)
    return report.select(
        F.col("week_start").cast("string").alias("week_start"), "period_kind", "metric", "value", "pct_change"
    )


@check("win_pair_week_weekend", """
WITH w AS (SELECT date_trunc('week', o_orderdate) AS week_start, count(*) AS orders FROM orders GROUP BY 1),
e AS (SELECT date_trunc('week', o_orderdate) AS week_start, count(*) AS orders FROM orders WHERE isodow(o_orderdate) >= 5 AND o_orderpriority = '1-URGENT' GROUP BY 1)
SELECT strftime(week_start, '%Y-%m-%d') AS week_start, w.orders AS orders, coalesce(e.orders, 0) AS weekend_orders
FROM w LEFT JOIN e USING (week_start)""")
def win_pair_week_weekend(spark, sf):
    # Urgent orders only, so that some weeks have no weekend row and must get a zero.
    day = F.col("o_orderdate")
    orders = s.table(spark, sf, "orders").withColumns({"week_start": week_start(day), "is_weekend": weekend_flag(day)})
    counted = F.count(F.lit(1)).alias("orders")
    weeks = orders.groupBy("week_start").agg(counted)
    urgent = orders.where(F.col("is_weekend") & (F.col("o_orderpriority") == "1-URGENT"))
    weekends = urgent.groupBy("week_start").agg(counted)
    paired = windows.pair_week_weekend(weeks, weekends, "week_start", ["orders"])
    return paired.withColumn("week_start", F.col("week_start").cast("string"))


@check("sort_multi", f"""
WITH {s.FACT_SQL}
SELECT month, region, shop_name, channel, year0_checkout FROM fact
ORDER BY month NULLS FIRST, region NULLS FIRST, shop_name NULLS FIRST, channel DESC NULLS LAST""")
def sort_multi(spark, sf):
    fact = fact_sums(s.facts(spark, sf))
    return fact.orderBy("month", "region", "shop_name", F.desc("channel"), "company").select(
        F.col("month").cast("bigint").alias("month"), "region", "shop_name", "channel", "year0_checkout"
    )


@check("sort_order_date", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day FROM orders ORDER BY o_orderdate, o_orderkey""")
def sort_order_date(spark, sf):
    ordered = s.table(spark, sf, "orders").orderBy("o_orderdate", "o_orderkey")
    return ordered.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_day"))


@check("sort_week", f"""
WITH {WEEKLY_SQL} SELECT CAST(week_start AS VARCHAR) AS week_start, period_kind, metric, value FROM weekly
ORDER BY weekly.week_start, period_kind, metric""")
def sort_week(spark, sf):
    weekly = weekly_metrics(s.lines(spark, sf), metric_rules(), s.SHOP_RULES).orderBy("week_start", "period_kind", "metric")
    return weekly.select(F.col("week_start").cast("string").alias("week_start"), "period_kind", "metric", "value")


@check("sort_abs_diff", f"WITH {RECON_SQL} SELECT barcode, own_barcode, diff FROM recon ORDER BY abs(diff) DESC, barcode")
def sort_abs_diff(spark, sf):
    rows = recon(spark, sf, ordered=False).select("barcode", "own_barcode", "diff")
    return reshape.sort_by_abs(rows, "diff", "barcode", "own_barcode")


@check("set_union_all", """
SELECT o_orderkey AS id, o_totalprice AS price, NULL AS name FROM orders
UNION ALL SELECT p_partkey, NULL, p_name FROM part
UNION ALL SELECT s_suppkey, s_acctbal, s_name FROM supplier""")
def set_union_all(spark, sf):
    orders = s.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))
    parts = s.table(spark, sf, "part").select(F.col("p_name").alias("name"), F.col("p_partkey").alias("id"))
    suppliers = s.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("price"), F.col("s_name").alias("name")
    )
    return reshape.append_all([orders, parts, suppliers])


_YEARS = range(1995, 2002)  # all years of the table


def _per_year(metric: str, count: str) -> str:
    columns = ", ".join(f"count({count}) FILTER (year(o_orderdate) = {y}) AS y{y}" for y in _YEARS)
    return f"SELECT '{metric}' AS metric, {columns} FROM orders"


@check("reshape_transpose", f"{_per_year('orders', '*')} UNION ALL {_per_year('customers', 'DISTINCT o_custkey')}")
def reshape_transpose(spark, sf):
    per_year = s.table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("orders"), F.count_distinct("o_custkey").alias("customers")
    )
    rows = reshape.metrics_to_rows(per_year, ["year"], ["orders", "customers"])
    wide = reshape.periods_to_columns(rows, "metric", "year", list(_YEARS))
    return wide.toDF("metric", *[f"y{y}" for y in _YEARS])


@check("reshape_keyed_map", """
SELECT o_orderpriority AS priority, string_agg(o_orderstatus || ':' || n, ' ' ORDER BY o_orderstatus) AS orders_by_status FROM (
  SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1""")
def reshape_keyed_map(spark, sf):
    counts = s.table(spark, sf, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))
    mapped = reshape.keyed_map(counts, "o_orderstatus", ["orders"], ["o_orderpriority"])
    pairs = F.transform(
        F.map_entries("orders"), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))
    )
    return mapped.select(F.col("o_orderpriority").alias("priority"), F.array_join(pairs, " ").alias("orders_by_status"))


@check("reshape_records", """
SELECT '{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '","p_size":' || p_size || '}' AS record FROM part""")
def reshape_records(spark, sf):
    return reshape.to_records(s.table(spark, sf, "part").select("p_partkey", "p_name", "p_size"))

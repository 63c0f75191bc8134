"""Projections, filters and buckets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from retailgrain.checks import standins as s
from retailgrain.checks.registry import check
from retailgrain.functions import bucket, city_group, join_nullable, normalize_barcode
from retailgrain.functions.dates import report_window, weekend_flag
from retailgrain.operators import filters, projections
from retailgrain.operators.joins import full_outer_match
from retailgrain.plans.stock_recon import MatchLabels, match_type, zero_orphan
from retailgrain.rules.fixed_values import QUANTITY_BUCKETS, QUANTITY_OTHER, price_buckets

LABELS = MatchLabels("matched", "theirs only", "ours only")


@check("proj_channel_case", """
SELECT o_orderkey, CASE WHEN o_custkey % 4 = 0 THEN 'TC' ELSE 'EU' END AS channel FROM orders""")
def proj_channel_case(spark, sf):
    company = F.when(F.col("o_custkey") % 4 == 0, 1000).otherwise(2000)
    return s.table(spark, sf, "orders").select("o_orderkey", projections.channel_of(company).alias("channel"))


@check("proj_null_fallback", f"""
WITH {s.DETAILS_SQL}
SELECT id, coalesce(p_name, supplier_article_id) AS product
FROM details LEFT JOIN part ON product_id = p_partkey""")
def proj_null_fallback(spark, sf):
    named = s.products(spark, sf).withColumnsRenamed({"id": "product_id"})
    joined = s.details(spark, sf).join(named, "product_id", "left")
    return joined.select("id", F.coalesce("descr", "supplier_article_id").alias("product"))


@check("proj_concat_nullable", f"""
WITH {s.HEADERS_SQL}
SELECT id, trim(CASE WHEN id % 13 <> 0 THEN street END || ' ' || coalesce(country, '')) AS address FROM headers""")
def proj_concat_nullable(spark, sf):
    street = F.when(F.col("id") % 13 != 0, F.col("street"))
    return s.headers(spark, sf).select("id", join_nullable(street, F.col("country")).alias("address"))


@check("proj_date_format", """
SELECT o_orderkey, strftime(o_orderdate, '%Y.%m.%d') AS day_text,
  datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS day_number FROM orders""")
def proj_date_format(spark, sf):
    day = F.to_date("o_orderdate")
    return s.table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy.MM.dd").alias("day_text"),
        F.datediff(day, F.lit(dt.date(1995, 1, 1))).cast("bigint").alias("day_number"),
    )


@check("proj_alias", """
SELECT p_partkey AS product_id, p_name AS product_name, p_retailprice AS price FROM part""")
def proj_alias(spark, sf):
    names = {"p_partkey": "product_id", "p_name": "product_name", "p_retailprice": "price"}
    return projections.rename(s.table(spark, sf, "part"), names).select(*names.values())


@check("proj_header_trim", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def proj_header_trim(spark, sf):
    nation = s.table(spark, sf, "nation")
    padded = nation.toDF(*[f"  {c} " for c in nation.columns])
    return projections.trim_headers(padded)


@check("proj_exclude_cols", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem""")
def proj_exclude_cols(spark, sf):
    unwanted = ["l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    return projections.exclude_columns(s.table(spark, sf, "lineitem"), unwanted)


@check("proj_cols_by_pattern", "SELECT p_partkey, p_retailprice, p_size FROM part")
def proj_cols_by_pattern(spark, sf):
    return projections.columns_like(s.table(spark, sf, "part"), ["price", "key", "size"])


@check("proj_cast", """
SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS custkey_double, CAST(trunc(o_totalprice) AS BIGINT) AS price_int,
  CAST(left(o_orderpriority, 1) AS BIGINT) AS priority_number, TRY_CAST(o_orderstatus AS BIGINT) AS status_number
FROM orders""")
def proj_cast(spark, sf):
    return s.table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("double").alias("custkey_double"),
        F.col("o_totalprice").cast("bigint").alias("price_int"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("priority_number"),
        F.col("o_orderstatus").try_cast("bigint").alias("status_number"),
    )


@check("proj_line_total", """
SELECT l_orderkey, l_linenumber, l_extendedprice * l_quantity AS line_total FROM lineitem""")
def proj_line_total(spark, sf):
    total = F.col("l_extendedprice") * F.col("l_quantity")
    return s.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", total.alias("line_total"))


@check("filter_date_range", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day FROM orders
WHERE o_orderdate >= DATE '2001-05-21' AND o_orderdate < DATE '2001-07-30'""")
def filter_date_range(spark, sf):
    start, end = report_window(s.AS_OF)
    rows = filters.date_range(s.table(spark, sf, "orders"), "o_orderdate", start, end)
    return rows.select("o_orderkey", F.to_date("o_orderdate").cast("string").alias("order_day"))


@check("filter_date_range_new_year", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '2000-11-06' AND TIMESTAMP '2001-01-15'""")
def filter_date_range_new_year(spark, sf):
    start, end = report_window(dt.date(2001, 1, 15))
    rows = filters.date_range(s.table(spark, sf, "orders"), "o_orderdate", start, end, closed="both")
    return rows.select("o_orderkey", F.to_date("o_orderdate").cast("string").alias("order_day"))


@check("filter_null_safe_ne", f"""
WITH {s.HEADERS_SQL}
SELECT id, order_status FROM headers WHERE order_status IS DISTINCT FROM 'wait_payment'""")
def filter_null_safe_ne(spark, sf):
    rows = s.headers(spark, sf).where(filters.not_equal_keep_null(F.col("order_status"), "wait_payment"))
    return rows.select("id", "order_status")


@check("filter_eq_and", f"""
WITH {s.FACTS_SQL}
SELECT CAST(full_date AS VARCHAR) AS day, region, channel, shop_name FROM facts WHERE month = 6 AND company = 'A'""")
def filter_eq_and(spark, sf):
    rows = s.facts(spark, sf).where((F.col("month") == 6) & (F.col("company") == "A"))
    return rows.select(F.col("full_date").cast("string").alias("day"), "region", "channel", "shop_name")


@check("filter_isin", """
SELECT p_partkey, p_type FROM part WHERE p_type IN ('PROMO', 'SMALL')""")
def filter_isin(spark, sf):
    return s.table(spark, sf, "part").where(F.col("p_type").isin("PROMO", "SMALL")).select("p_partkey", "p_type")


@check("filter_eq", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'MACHINERY'")
def filter_eq(spark, sf):
    return s.table(spark, sf, "customer").where(F.col("c_mktsegment") == "MACHINERY").select("c_custkey", "c_name")


@check("filter_bool_flag", """
SELECT o_orderkey FROM orders WHERE isodow(o_orderdate) >= 5""")
def filter_bool_flag(spark, sf):
    flagged = s.table(spark, sf, "orders").withColumn("is_weekend", weekend_flag(F.col("o_orderdate")))
    return flagged.where(F.col("is_weekend")).select("o_orderkey")


@check("filter_date_eq", """
SELECT event_id, event_type FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'""")
def filter_date_eq(spark, sf):
    return filters.on_day(s.table(spark, sf, "events"), "ts", dt.date(2024, 1, 15)).select("event_id", "event_type")


@check("filter_not_null", f"WITH {s.STOCK_SQL} SELECT barcode, brand FROM supplier_stock WHERE barcode IS NOT NULL")
def filter_not_null(spark, sf):
    return s.supplier_stock(spark, sf).dropna(subset=["barcode"]).select("barcode", "brand")


MATCHED_SQL = f"""{s.STOCK_SQL},
clean AS (SELECT {s.CLEAN_SQL} AS barcode, quantity FROM supplier_stock),
own AS (SELECT barcode AS own_barcode, quantity AS own_quantity, 1 AS is_own FROM own_stock),
matched AS (
  SELECT barcode, own_barcode, coalesce(quantity, 0) AS quantity, coalesce(own_quantity, 0) AS own_quantity,
    CASE WHEN is_own IS NULL THEN 'theirs only' WHEN is_theirs IS NULL THEN 'ours only' ELSE 'matched' END AS match_type
  FROM (SELECT *, 1 AS is_theirs FROM clean) FULL OUTER JOIN own ON barcode = own_barcode)"""


def matched_stock(spark, sf):
    theirs = s.supplier_stock(spark, sf).select(normalize_barcode(F.col("barcode")).alias("barcode"), "quantity")
    own = s.own_stock(spark, sf).select(
        F.col("barcode").alias("own_barcode"), F.col("quantity").alias("own_quantity")
    )
    rows = full_outer_match(theirs, own, "barcode", "own_barcode")
    return rows.withColumn("match_type", match_type(F.col("side"), LABELS))


@check("filter_zero_orphans", f"""
WITH {MATCHED_SQL}
SELECT * FROM matched WHERE NOT (match_type = 'theirs only' AND trunc(quantity) = 0)
  AND NOT (match_type = 'ours only' AND trunc(own_quantity) = 0)""")
def filter_zero_orphans(spark, sf):
    rows = matched_stock(spark, sf).drop("side").na.fill(0, subset=["quantity", "own_quantity"])
    return rows.where(~zero_orphan(LABELS))


@check("fill_nulls", f"""
WITH {MATCHED_SQL}
SELECT coalesce(barcode, own_barcode, 'none') AS code, quantity, own_quantity FROM matched""")
def fill_nulls(spark, sf):
    filled = projections.fill_defaults(
        matched_stock(spark, sf),
        {"quantity": 0.0, "own_quantity": 0.0, "barcode": F.coalesce("own_barcode", F.lit("none"))},
    )
    return filled.select(F.col("barcode").alias("code"), "quantity", "own_quantity")


@check("match_type", f"""
WITH {MATCHED_SQL} SELECT match_type, count(*) AS row_count FROM matched GROUP BY 1""")
def match_type_counts(spark, sf):
    return matched_stock(spark, sf).groupBy("match_type").agg(F.count(F.lit(1)).alias("row_count"))


PRICE_CASE = """CASE WHEN {x} <= 50 THEN '(0) 0 iki 50 Eur' WHEN {x} <= 100 THEN '(1) 51 iki 100 Eur'
  WHEN {x} <= 180 THEN '(2) 101 iki 180 Eur' WHEN {x} <= 200 THEN '(3) 181 iki 200 Eur'
  WHEN {x} <= 250 THEN '(4) 201 iki 250 Eur' WHEN {x} <= 1000 THEN '(5) 251 iki 1000 Eur'
  WHEN {x} > 1000 THEN '(6) 1000 ir daugiau Eur' END"""
QUANTITY_CASE = """CASE WHEN {x} = 1 THEN '(0) Viena prekė' WHEN {x} = 2 THEN '(1) Dvi prekės'
  WHEN {x} > 2 AND {x} <= 5 THEN '(2) Nuo 3 iki 5 prekių' WHEN {x} > 5 THEN '(3) 6 ir daugiau preki7' ELSE 'Error' END"""


@check("bucket_price", f"""
SELECT {PRICE_CASE.format(x='nullif(floor(l_extendedprice / 80), 50)')} AS price_bucket, count(*) AS row_count
FROM lineitem GROUP BY 1""")
def bucket_price(spark, sf):
    price = F.nullif(F.floor(F.col("l_extendedprice") / 80).cast("double"), F.lit(50.0))
    rows = s.table(spark, sf, "lineitem").select(bucket(price, price_buckets()).alias("price_bucket"))
    return rows.groupBy("price_bucket").agg(F.count(F.lit(1)).alias("row_count"))


@check("bucket_quantity", f"""
SELECT {QUANTITY_CASE.format(x='(l_quantity / 2 - 1)')} AS quantity_bucket, count(*) AS row_count
FROM lineitem GROUP BY 1""")
def bucket_quantity(spark, sf):
    quantity = F.col("l_quantity") / 2 - 1
    label = bucket(quantity, QUANTITY_BUCKETS, QUANTITY_OTHER).alias("quantity_bucket")
    return s.table(spark, sf, "lineitem").select(label).groupBy("quantity_bucket").agg(
        F.count(F.lit(1)).alias("row_count")
    )


@check("class_city_group", """
SELECT c_custkey, CASE WHEN contains(lower(n_name), 'nation_1') THEN 'Vilnius'
  WHEN contains(lower(n_name), 'nation_2') THEN 'Kaunas' ELSE 'Kiti miestai' END AS city_group
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def class_city_group(spark, sf):
    joined = s.table(spark, sf, "customer").join(
        s.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.select("c_custkey", city_group(F.col("n_name"), s.SCOPES.city_groups).alias("city_group"))

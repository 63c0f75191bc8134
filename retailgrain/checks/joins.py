"""Joins and rule matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from retailgrain.checks import standins as s
from retailgrain.checks.columns import MATCHED_SQL, matched_stock
from retailgrain.checks.registry import check
from retailgrain.functions import fix_address_spacing, normalize_barcode, str_normalize
from retailgrain.functions.matching import matched_shops
from retailgrain.operators import joins
from retailgrain.operators.aggregates import group_sums
from retailgrain.operators.projections import tag_first_substring
from retailgrain.operators.rule_joins import shop_pairs_by_join, tag_first_substring_by_join
from retailgrain.operators.windows import group_row_count
from retailgrain.rules.tables import barcode_table, rule_table


@check("join_inner_equi", """
SELECT l_orderkey, l_linenumber, o_custkey, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def join_inner_equi(spark, sf):
    joined = s.table(spark, sf, "lineitem").join(
        s.table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"), "inner"
    )
    return joined.select("l_orderkey", "l_linenumber", "o_custkey", "o_orderstatus")


@check("join_left_equi", f"""
WITH {s.DETAILS_SQL} SELECT id, p_name AS product FROM details LEFT JOIN part ON product_id = p_partkey""")
def join_left_equi(spark, sf):
    named = s.products(spark, sf).select(F.col("id").alias("product_id"), F.col("descr").alias("product"))
    return s.details(spark, sf).join(named, "product_id", "left").select("id", "product")


@check("join_left_composite", f"""
WITH {s.HEADERS_SQL},{s.DELIVERIES_SQL}
SELECT id, descr AS delivery FROM headers LEFT JOIN deliveries ON delivery_type = oxid AND company_id = trade_network_id""")
def join_left_composite(spark, sf):
    pairs = [("delivery_type", "oxid"), ("company_id", "trade_network_id")]
    joined = joins.composite_left(s.headers(spark, sf), s.deliveries(spark), pairs)
    return joined.select("id", F.col("descr").alias("delivery"))


@check("join_full_outer", f"WITH {MATCHED_SQL} SELECT barcode, own_barcode, match_type FROM matched")
def join_full_outer(spark, sf):
    return matched_stock(spark, sf).select("barcode", "own_barcode", "match_type")


@check("join_map_lookup", f"""
WITH {s.STOCK_SQL},{s.EXCEPTIONS_SQL},
clean AS (SELECT {s.CLEAN_SQL} AS barcode, brand FROM supplier_stock)
SELECT coalesce(to_code, barcode) AS barcode, brand FROM clean LEFT JOIN exceptions ON barcode = from_code""")
def join_map_lookup(spark, sf):
    clean = s.supplier_stock(spark, sf).select(normalize_barcode(F.col("barcode")).alias("barcode"), "brand")
    return joins.map_lookup(clean, "barcode", barcode_table(spark, s.EXCEPTIONS), "from_code", "to_code")


ADDRESS_SQL = f"""{s.HEADERS_SQL},
addressed AS (SELECT id, lower(trim(street || ' ' || coalesce(country, ''))) AS a FROM headers)"""


def addressed(spark, sf):
    address = F.trim(F.concat("street", F.lit(" "), F.coalesce("country", F.lit(""))))
    return s.headers(spark, sf).select("id", address.alias("address"))


FIRST_CITY_SQL = f"""
WITH {ADDRESS_SQL}
SELECT id, CASE WHEN contains(a, 'nation_1') THEN 'One' WHEN contains(a, 'nation_10') THEN 'Ten'
  WHEN contains(a, 'nation_2') THEN 'Two' WHEN contains(a, 'asia') THEN 'Asian'
  WHEN contains(a, 'nation_3') THEN 'Three' ELSE 'Elsewhere' END AS city FROM addressed"""


@check("join_first_substring", FIRST_CITY_SQL)
def join_first_substring(spark, sf):
    return tag_first_substring(addressed(spark, sf), "address", "city", s.CITY_RULES, s.OTHER_CITY).select("id", "city")


@check("join_first_substring_longest", f"""
WITH {ADDRESS_SQL}
SELECT id, CASE WHEN contains(a, 'nation_10') THEN 'Ten' WHEN contains(a, 'nation_1') THEN 'One'
  WHEN contains(a, 'nation_2') THEN 'Two' WHEN contains(a, 'nation_3') THEN 'Three'
  WHEN contains(a, 'asia') THEN 'Asian' ELSE 'Elsewhere' END AS city FROM addressed""")
def join_first_substring_longest(spark, sf):
    rows = addressed(spark, sf)
    return tag_first_substring(rows, "address", "city", s.CITY_RULES, s.OTHER_CITY, "longest").select("id", "city")


@check("join_first_substring_table", FIRST_CITY_SQL)
def join_first_substring_table(spark, sf):
    rules = rule_table(spark, s.CITY_RULES)
    return tag_first_substring_by_join(addressed(spark, sf), "address", "city", rules, s.OTHER_CITY).select("id", "city")


SHOPS_CASE_SQL = """
CASE WHEN contains(a, 'nation_1') THEN 'Nation_1, One' END,
CASE WHEN contains(a, 'nation_11 g. 7') THEN 'nation_11 g. 7, Eleven' END,
CASE WHEN contains(a, 'nation_2') AND contains(a, 'asia') THEN 'Nation_2, Asia' END,
CASE WHEN a = 'nation_5 g. 3' THEN 'NATION_5 g. 3 , Five' END,
CASE WHEN contains(a, 'nation_12 g. 1') AND contains(a, 'america') THEN 'nation_12 g. 1, America' END,
CASE WHEN a = 'nation_10 g. 25' AND contains(a, 'nation_10') THEN 'nation_10 g. 25, nation_10' END"""


@check("join_rule_theta", f"""
WITH {s.LINES_SQL},
spaced AS (SELECT DISTINCT lower(trim(replace(address, 'g.', 'g. '))) AS a, delivery FROM lines
  WHERE lower(trim(delivery)) IN ('atsiemimas parduotuveje', 'atsiemimas parduotuve', 'savitarna'))
SELECT a AS address, delivery, shop FROM (SELECT a, delivery, unnest([{SHOPS_CASE_SQL}]) AS shop FROM spaced) WHERE shop IS NOT NULL""")
def join_rule_theta(spark, sf):
    subject = str_normalize(fix_address_spacing(F.col("address")))
    pairs = s.lines(spark, sf).select(subject.alias("address"), "delivery").distinct()
    shops = matched_shops(F.col("address"), F.col("delivery"), s.SHOP_RULES, is_normalized=True)
    return pairs.select("address", "delivery", F.explode(shops).alias("shop"))


@check("join_rule_theta_table", f"""
WITH {s.HEADERS_SQL},
addressed AS (SELECT DISTINCT lower(trim(replace(street, 'g.', 'g. ') || ' ' || coalesce(country, ''))) AS a FROM headers)
SELECT a AS address, CAST(i AS BIGINT) AS shop_number FROM (
  SELECT a, unnest([CASE WHEN contains(a, 'nation_1') THEN 0 END, CASE WHEN contains(a, 'nation_11 g. 7') THEN 1 END,
    CASE WHEN contains(a, 'nation_2') AND contains(a, 'asia') THEN 2 END, CASE WHEN a = 'nation_5 g. 3' THEN 3 END,
    CASE WHEN contains(a, 'nation_12 g. 1') AND contains(a, 'america') THEN 4 END,
    CASE WHEN a = 'nation_10 g. 25' THEN 5 END]) AS i FROM addressed) WHERE i IS NOT NULL""")
def join_rule_theta_table(spark, sf):
    spaced = addressed(spark, sf).select(F.replace("address", F.lit("g."), F.lit("g. ")).alias("address"))
    pairs = shop_pairs_by_join(spaced, "address", rule_table(spark, s.SHOP_RULES))
    return pairs.select(F.col("subject").alias("address"), F.col("ordinal").cast("bigint").alias("shop_number"))


@check("join_group_count", """
SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_orderkey) AS order_rows FROM lineitem""")
def join_group_count(spark, sf):
    rows = s.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return group_row_count(rows, "l_orderkey")


@check("join_scalar_total", """
WITH per_type AS (SELECT p_type, sum(p_size) AS size_sum FROM part GROUP BY 1)
SELECT p_type, CAST(size_sum AS BIGINT) AS size_sum, CAST((SELECT sum(size_sum) FROM per_type) AS BIGINT) AS size_total FROM per_type""")
def join_scalar_total(spark, sf):
    per_type = s.table(spark, sf, "part").groupBy("p_type").agg(F.sum("p_size").alias("size_sum"))
    total = s.table(spark, sf, "part").agg(F.sum("p_size").alias("size_sum"))
    joined = joins.with_total(per_type, total, ["size_sum"])
    return joined.select("p_type", "size_sum", F.col("_total.size_sum").alias("size_total"))


@check("join_densify", """
WITH seen AS (SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS n FROM orders
  WHERE o_orderpriority <> '1-URGENT' OR o_orderstatus = 'F' GROUP BY 1, 2),
wanted AS (SELECT status, priority FROM (VALUES ('F'), ('O'), ('P')) v(status) CROSS JOIN (SELECT DISTINCT o_orderpriority AS priority FROM orders))
SELECT status, priority, coalesce(n, 0) AS n FROM wanted LEFT JOIN seen USING (status, priority)""")
def join_densify(spark, sf):
    orders = s.table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), F.lit(1).cast("bigint").alias("n")
    )
    seen = group_sums(orders.where((F.col("priority") != "1-URGENT") | (F.col("status") == "F")), ["status", "priority"], ["n"])
    return joins.densify(seen, "status", ["F", "O", "P"], "priority", orders, ["n"])

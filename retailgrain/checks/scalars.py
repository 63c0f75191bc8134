"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from retailgrain import functions as fn
from retailgrain.checks import standins as s
from retailgrain.checks.registry import check
from retailgrain.operators.reshape import append_all
from retailgrain.rules.fixed_values import SPECIAL_CHARACTERS
from retailgrain.sources.readers import file_fingerprints


@check("str_normalize", """
SELECT p_partkey, lower(trim('  ' || p_name || ' ', ' ')) || '|' AS normalized FROM part""")
def str_normalize(spark, sf):
    padded = F.concat(F.lit("  "), F.upper("p_name"), F.lit(" \t"))
    return s.table(spark, sf, "part").select(
        "p_partkey", F.concat(fn.str_normalize(padded), F.lit("|")).alias("normalized")
    )


@check("str_contains", "SELECT doc_id, contains(text, 'the') AS has_word FROM documents")
def str_contains(spark, sf):
    return s.table(spark, sf, "documents").select("doc_id", fn.str_contains(F.col("text"), "the").alias("has_word"))


@check("fix_address_spacing", """
SELECT doc_id, md5(CASE WHEN contains(text, '.') AND NOT contains(trim(text, chr(32) || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)), '. ')
  THEN replace(text, '.', '. ') ELSE text END) AS fixed_md5 FROM documents
UNION ALL
SELECT o_orderkey + 1000000000, md5(CASE WHEN o_custkey % 3 = 0 THEN 'Gatvė. ' || CAST(o_custkey AS VARCHAR)
  ELSE 'Gatvė g. ' || CAST(o_custkey AS VARCHAR) END) FROM orders""")
def fix_address_spacing(spark, sf):
    texts = s.table(spark, sf, "documents").select(
        "doc_id", F.md5(fn.fix_address_spacing(F.col("text"))).alias("fixed_md5")
    )
    cust = F.col("o_custkey")
    address = F.when(cust % 3 == 0, F.concat(F.lit("Gatvė. "), cust.cast("string"))).otherwise(
        F.concat(F.lit("Gatvė g."), cust.cast("string"))
    )
    streets = s.table(spark, sf, "orders").select(
        (F.col("o_orderkey") + 1_000_000_000).alias("doc_id"),
        F.md5(fn.fix_address_spacing(address)).alias("fixed_md5"),
    )
    return append_all([texts, streets])


@check("normalize_barcode", f"""
WITH {s.STOCK_SQL}
SELECT barcode AS raw, {s.CLEAN_SQL} AS barcode, brand FROM supplier_stock
UNION ALL
SELECT CAST(l_orderkey * 10000000000 + l_partkey AS VARCHAR),
  lpad(CAST(l_orderkey * 10000000000 + l_partkey AS VARCHAR), 12, '0'), l_returnflag FROM lineitem""")
def normalize_barcode(spark, sf):
    stock = s.supplier_stock(spark, sf).select(
        F.col("barcode").alias("raw"), fn.normalize_barcode(F.col("barcode")).alias("barcode"), "brand"
    )
    number = F.col("l_orderkey") * 10_000_000_000 + F.col("l_partkey")
    numeric = s.table(spark, sf, "lineitem").select(
        number.cast("string").alias("raw"),
        fn.normalize_barcode(number).alias("barcode"),
        F.col("l_returnflag").alias("brand"),
    )
    return append_all([stock, numeric])


_CHARS_SQL = " || ".join(f"chr({ord(c)})" for c in SPECIAL_CHARACTERS)


@check("clean_text", f"""
SELECT doc_id, md5(trim(translate(text, {_CHARS_SQL}, ''), chr(32) || chr(9) || chr(10) || chr(13) || chr(11) || chr(12))) AS cleaned_md5 FROM documents""")
def clean_text(spark, sf):
    return s.table(spark, sf, "documents").select("doc_id", F.md5(fn.clean_text(F.col("text"))).alias("cleaned_md5"))


@check("str_concat", "SELECT s_suppkey, s_name || ' / ' || CAST(s_nationkey AS VARCHAR) AS label FROM supplier")
def str_concat(spark, sf):
    label = F.concat("s_name", F.lit(" / "), F.col("s_nationkey").cast("string"))
    return s.table(spark, sf, "supplier").select("s_suppkey", label.alias("label"))


@check("iso_week", "SELECT o_orderkey, CAST(weekofyear(o_orderdate) AS BIGINT) AS iso_week FROM orders")
def iso_week(spark, sf):
    return s.table(spark, sf, "orders").select(
        "o_orderkey", fn.iso_week(F.col("o_orderdate")).cast("bigint").alias("iso_week")
    )


@check("week_start", """
SELECT l_orderkey, l_linenumber, strftime(date_trunc('week', l_shipdate), '%Y-%m-%d') AS week_start FROM lineitem""")
def week_start(spark, sf):
    return s.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", fn.week_start(F.col("l_shipdate")).cast("string").alias("week_start")
    )


def _label_sql(first: int) -> str:
    monday = "date_trunc('week', o_orderdate)"
    return (
        f"strftime({monday} + INTERVAL {first} DAY, '%m-%d') || ' iki ' || "
        f"strftime({monday} + INTERVAL 6 DAY, '%m-%d')"
    )


@check("week_label", f"SELECT o_orderkey, {_label_sql(0)} AS label FROM orders")
def week_label(spark, sf):
    return s.table(spark, sf, "orders").select("o_orderkey", fn.week_label(F.col("o_orderdate")).alias("label"))


@check("weekend_label", f"SELECT o_orderkey, {_label_sql(4)} AS label FROM orders")
def weekend_label(spark, sf):
    return s.table(spark, sf, "orders").select("o_orderkey", fn.weekend_label(F.col("o_orderdate")).alias("label"))


@check("weekend_flag", "SELECT o_orderkey, isodow(o_orderdate) >= 5 AS is_weekend FROM orders")
def weekend_flag(spark, sf):
    return s.table(spark, sf, "orders").select("o_orderkey", fn.weekend_flag(F.col("o_orderdate")).alias("is_weekend"))


@check("date_shift", """
SELECT o_orderkey, strftime(o_orderdate - INTERVAL 70 DAY, '%Y-%m-%d') AS ten_weeks_before,
  strftime(o_orderdate + INTERVAL 6 DAY, '%Y-%m-%d') AS six_days_after,
  CAST(month(o_orderdate - INTERVAL 1 DAY) AS BIGINT) AS month_of_yesterday FROM orders""")
def date_shift(spark, sf):
    day = F.to_date("o_orderdate")
    return s.table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format(F.date_sub(day, 70), "yyyy-MM-dd").alias("ten_weeks_before"),
        F.date_format(F.date_add(day, 6), "yyyy-MM-dd").alias("six_days_after"),
        F.month(F.date_sub(day, 1)).cast("bigint").alias("month_of_yesterday"),
    )


@check("half_even_int", """
SELECT l_orderkey, l_linenumber, CAST(round_even((l_quantity - 25) / 2, 0) AS BIGINT) AS rounded FROM lineitem""")
def half_even_int(spark, sf):
    return s.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", fn.half_even_int((F.col("l_quantity") - 25) / 2).alias("rounded")
    )


@check("trunc_int", """
SELECT c_custkey, CAST(trunc(c_acctbal - 5000) AS BIGINT) AS truncated FROM customer""")
def trunc_int(spark, sf):
    return s.table(spark, sf, "customer").select("c_custkey", fn.trunc_int(F.col("c_acctbal") - 5000).alias("truncated"))


@check("abs_value", "SELECT c_custkey, abs(c_acctbal - 5000) AS distance FROM customer")
def abs_value(spark, sf):
    return s.table(spark, sf, "customer").select("c_custkey", F.abs(F.col("c_acctbal") - 5000).alias("distance"))


@check("safe_ratio_pct", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 THEN 0
  ELSE CAST(round_even(l_tax / l_discount * 100, 0) AS BIGINT) END AS pct FROM lineitem""")
def safe_ratio_pct(spark, sf):
    return s.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", fn.safe_ratio_pct(F.col("l_tax"), F.col("l_discount")).alias("pct")
    )


@check("null_default", f"WITH {s.HEADERS_SQL} SELECT id, coalesce(country, '') AS country FROM headers")
def null_default(spark, sf):
    return s.headers(spark, sf).select("id", fn.null_default(F.col("country"), "").alias("country"))


_DIGEST_SQL = """CAST('0x' || substr(md5(concat_ws(chr(31), CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
  CAST(l_partkey AS VARCHAR), l_linestatus)), 1, 15) AS BIGINT)"""


@check("content_fingerprint", f"""
SELECT l_returnflag AS source_file, CAST(sum({_DIGEST_SQL}) AS VARCHAR) AS content_hash, count(*) AS row_count
FROM lineitem GROUP BY 1""")
def content_fingerprint(spark, sf):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_linestatus"]
    return file_fingerprints(
        s.table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "source_file"), columns
    )

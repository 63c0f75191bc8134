"""The given tables seen as orders, stock and sales facts; each frame has an SQL twin.

Derived columns only: no frame leaves rows of its tables out.
"""

from __future__ import annotations

import datetime as dt
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from retailgrain.plans.order_lines import order_lines
from retailgrain.plans.yoy_sales import SalesScopes
from retailgrain.rules.fixed_values import city_rules, shop_rules
from retailgrain.rules.tables import CityRule, ShopRule, local_table

# The Mondays around all order dates of the test data.
FIRST_MONDAY = dt.date(1994, 12, 26)
LAST_MONDAY = dt.date(2001, 8, 6)
AS_OF = dt.date(2001, 7, 30)

DELIVERIES = (
    ("1-URGENT", 1000, "LP Express"),
    ("1-URGENT", 2000, "Omniva pastomatas"),
    ("2-HIGH", 1000, "atsiemimas parduotuveje"),
    ("2-HIGH", 2000, " Savitarna"),
    ("3-MEDIUM", 1000, "DPD terminalas"),
    ("3-MEDIUM", 2000, "Pristatymas i namus "),
    ("4-NOT SPECIFIED", 1000, "atsiemimas parduotuve "),
)
CITY_RULES = (
    CityRule(0, "Nation_1", "One"),
    CityRule(1, "nation_10", "Ten"),
    CityRule(2, " NATION_2", "Two"),
    CityRule(3, "asia", "Asian"),
    CityRule(4, "nation_3", "Three"),
)
OTHER_CITY = "Elsewhere"
SHOP_RULES = (
    ShopRule(0, "Nation_1", "One"),
    ShopRule(1, "nation_11 g. 7", "Eleven"),
    ShopRule(2, "Nation_2", "Asia", and_city=True),
    ShopRule(3, "NATION_5 g. 3 ", "Five", equal=True),
    ShopRule(4, "nation_12 g. 1", "America", and_city=True),
    ShopRule(5, "nation_10 g. 25", "nation_10", and_city=True, equal=True),
)
SCOPES = SalesScopes(
    company="A",
    month=6,
    shop_regions=("AFRICA", "AMERICA", "ASIA"),
    online_region="EUROPE",
    b2b_region="MIDDLE EAST",
    other_regions=("MIDDLE EAST",),
    city_groups=(("nation_1", "Vilnius"), ("nation_2", "Kaunas")),
)


@lru_cache(maxsize=64)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; the handle is kept, so its schema is looked up once per session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micro(value):
    """A sum of fractions to six digits, so that its last bits do not matter."""
    return F.floor(value * 1e6 + 0.5) / 1e6


# ---- orders -------------------------------------------------------------------------------------

HEADERS_SQL = """
headers AS (
  SELECT o_orderkey AS id, CASE WHEN o_custkey % 2 = 0 THEN 1000 ELSE 2000 END AS company_id,
    CASE WHEN o_custkey % 50 <> 0
         THEN CAST(o_orderkey - CASE WHEN o_orderkey % 10 = 1 THEN 1 ELSE 0 END AS VARCHAR) END AS order_no,
    o_orderdate AS order_date,
    CASE WHEN o_orderstatus = 'F' THEN 'complete'
         WHEN o_orderstatus = 'O' AND o_custkey % 3 = 0 THEN 'wait_payment'
         WHEN o_orderstatus = 'O' AND o_custkey % 3 = 1 THEN 'processing'
         WHEN o_orderstatus = 'O' THEN 'canceled'
         WHEN o_custkey % 4 <> 0 THEN 'ORDEFOLDER_PREPARING' END AS order_status,
    o_orderstatus AS payment_status, o_orderpriority AS delivery_type,
    n_name || ' g.' || CAST(o_custkey % 40 AS VARCHAR) AS street,
    CASE WHEN n_nationkey % 5 <> 0 THEN r_name END AS country
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""


# The listed shops and cities as the places that orders go to.
PLACES = [f"{r.address}, {r.city}" for r in shop_rules()] + [f"{r.city} g.{r.ordinal}" for r in city_rules()]


def headers(spark: SparkSession, sf_dir: str, places: list[str] | None = None) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    placed = (
        table(spark, sf_dir, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    )
    cust, status = F.col("o_custkey"), F.col("o_orderstatus")
    shared = F.col("o_orderkey") - F.when(F.col("o_orderkey") % 10 == 1, 1).otherwise(0)
    return placed.select(
        F.col("o_orderkey").alias("id"),
        F.when(cust % 2 == 0, 1000).otherwise(2000).alias("company_id"),
        F.when(cust % 50 != 0, shared.cast("string")).alias("order_no"),
        F.col("o_orderdate").alias("order_date"),
        F.when(status == "F", "complete")
        .when((status == "O") & (cust % 3 == 0), "wait_payment")
        .when((status == "O") & (cust % 3 == 1), "processing")
        .when(status == "O", "canceled")
        .when(cust % 4 != 0, "ORDEFOLDER_PREPARING")
        .alias("order_status"),
        status.alias("payment_status"),
        F.col("o_orderpriority").alias("delivery_type"),
        (F.concat("n_name", F.lit(" g."), (cust % 40).cast("string")) if places is None else F.get(F.lit(places), (cust % len(places)).cast("int"))).alias("street"),
        F.when(F.col("n_nationkey") % 5 != 0, F.col("r_name")).alias("country"),
        F.lit(None).cast("string").alias("remark"),
    )


DETAILS_SQL = """
details AS (
  SELECT l_orderkey * 16 + l_linenumber AS id, l_orderkey AS header_id,
    CASE WHEN l_partkey % 10 <> 3 THEN l_partkey % 10 END AS product_id,
    CAST(l_suppkey % 3 AS VARCHAR) AS supplier_article_id,
    (floor(l_quantity / 10) * 55 + 20.25) * CASE WHEN l_discount = 0 THEN 10 ELSE 1 END AS price
  FROM lineitem)"""


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.col("l_partkey") % 10
    price = (F.floor(F.col("l_quantity") / 10) * 55 + F.lit(20.25).cast("double")) * F.when(
        F.col("l_discount") == 0, 10
    ).otherwise(1)
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 16 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("header_id"),
        F.when(part != 3, part).alias("product_id"),
        (F.col("l_suppkey") % 3).cast("string").alias("supplier_article_id"),
        price.alias("price"),
        F.lit(None).cast("string").alias("guarantee"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("descr"))


DELIVERY_SCHEMA = pa.schema([("oxid", pa.string()), ("trade_network_id", pa.int32()), ("descr", pa.string())])


def deliveries(spark: SparkSession) -> DataFrame:
    return local_table(spark, (dict(zip(DELIVERY_SCHEMA.names, row)) for row in DELIVERIES), DELIVERY_SCHEMA)


DELIVERIES_SQL = "deliveries(oxid, trade_network_id, descr) AS (VALUES " + ", ".join(
    f"('{a}', {b}, '{c}')" for a, b, c in DELIVERIES
) + ")"


def lines(spark: SparkSession, sf_dir: str, places: list[str] | None = None) -> DataFrame:
    """All order lines of the test data, to the places given or to nations."""
    return order_lines(
        headers(spark, sf_dir, places), details(spark, sf_dir), products(spark, sf_dir), deliveries(spark),
        FIRST_MONDAY, LAST_MONDAY,
    )


# Order lines the plain way: join, group, then count rows per order with a window.
LINES_SQL = f"""{HEADERS_SQL},{DETAILS_SQL},
{DELIVERIES_SQL},
grouped AS (
  SELECT company_id, order_no, order_date, order_status, payment_status, street, country,
    odt.descr AS delivery, p_name, supplier_article_id, price, count(d.id) AS line_count
  FROM details d JOIN headers h ON d.header_id = h.id
    LEFT JOIN part ON d.product_id = p_partkey
    LEFT JOIN deliveries odt ON h.delivery_type = odt.oxid AND h.company_id = odt.trade_network_id
  WHERE order_status IS DISTINCT FROM 'wait_payment'
    AND order_date >= DATE '{FIRST_MONDAY}' AND order_date < DATE '{LAST_MONDAY}'
  GROUP BY ALL),
lines AS (
  SELECT *, CASE WHEN company_id = 1000 THEN 'TC' ELSE 'EU' END AS channel,
    trim(street || ' ' || coalesce(country, '')) AS address,
    coalesce(p_name, supplier_article_id) AS product,
    CAST(date_trunc('week', order_date) AS DATE) AS week_start,
    isodow(order_date) >= 5 AS is_weekend,
    CASE WHEN order_no IS NULL THEN 0 ELSE 1.0::DOUBLE / count(*) OVER (PARTITION BY order_no) END AS order_weight,
    price * line_count AS line_total
  FROM grouped)"""

PLACED_LINES_SQL = LINES_SQL.replace(
    "n_name || ' g.' || CAST(o_custkey % 40 AS VARCHAR) AS street",
    "[" + ", ".join(f"'{p}'" for p in PLACES) + f"][o_custkey % {len(PLACES)} + 1] AS street",
)

# ---- sales facts --------------------------------------------------------------------------------

FACTS_SQL = """
facts AS (
  SELECT CAST(o_orderdate AS DATE) AS full_date, month(o_orderdate) AS month,
    CASE WHEN n_nationkey <> 7 THEN r_name END AS region,
    CASE WHEN o_custkey % 3 = 0 THEN 'B' ELSE 'A' END AS company,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS channel,
    CASE WHEN n_nationkey <> 3 THEN n_name END AS shop_name,
    year(o_orderdate) AS y, o_totalprice AS stotal, coalesce(n_lines, 0) AS people_in
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey),
wide AS (
  SELECT full_date, month, region, company, channel, shop_name,
    CASE WHEN y = 1998 THEN 1 END AS year0_minus_2_checkout,
    CASE WHEN y = 1999 THEN 1 END AS year0_minus_1_checkout,
    CASE WHEN y = 2000 THEN 1 END AS year0_checkout,
    CASE WHEN y = 1998 THEN stotal END AS year0_minus_2_stotal,
    CASE WHEN y = 1999 THEN stotal END AS year0_minus_1_stotal,
    CASE WHEN y = 2000 THEN stotal END AS year0_stotal,
    CASE WHEN y = 1998 THEN people_in END AS year0_minus_2_people_in,
    CASE WHEN y = 1999 THEN people_in END AS year0_minus_1_people_in,
    CASE WHEN y = 2000 THEN people_in END AS year0_people_in
  FROM facts)"""


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    visits = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"))
    placed = (
        table(spark, sf_dir, "orders")
        .join(visits, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    )
    year = F.year("o_orderdate")
    measures = {
        "stotal": F.col("o_totalprice"),
        "people_in": F.coalesce("n_lines", F.lit(0)),
        "checkout": F.lit(1),
    }
    years = {"year0_minus_2": 1998, "year0_minus_1": 1999, "year0": 2000}
    return placed.select(
        F.to_date("o_orderdate").alias("full_date"),
        F.month("o_orderdate").alias("month"),
        F.when(F.col("n_nationkey") != 7, F.col("r_name")).alias("region"),
        F.when(F.col("o_custkey") % 3 == 0, "B").otherwise("A").alias("company"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).alias("channel"),
        F.when(F.col("n_nationkey") != 3, F.col("n_name")).alias("shop_name"),
        *[
            F.when(year == y, value).cast("double").alias(f"{name}_{measure}")
            for measure, value in measures.items()
            for name, y in years.items()
        ],
    )


_YEARS = ("year0_minus_2", "year0_minus_1", "year0")
SUMS = [f"{y}_{m}" for m in ("stotal", "people_in", "checkout") for y in _YEARS]


def _rounded_sum(metric: str) -> str:
    if metric.endswith("checkout"):
        return f"CAST(sum({metric}) AS BIGINT) AS {metric}"
    return f"CAST(round(sum(CAST({metric} AS DECIMAL(28,6))), 0) AS BIGINT) AS {metric}"


FACT_SQL = f"""{FACTS_SQL},
fact AS MATERIALIZED (
  SELECT month, region, company, channel, shop_name, {", ".join(_rounded_sum(m) for m in SUMS)}
  FROM wide GROUP BY month, region, company, channel, shop_name)"""


def sums_sql(rows: str = "") -> str:
    """The nine sums, 0 where nothing was added."""
    return ", ".join(f"CAST(coalesce(sum({m}), 0) AS BIGINT) AS {m}" for m in SUMS)


def _ratio(n: str, d: str, factor: str = "") -> str:
    return f"CASE WHEN coalesce({d}, 0) = 0 THEN 0 ELSE CAST(round_even({n}::DOUBLE / {d}{factor}, 0) AS BIGINT) END"


def derived_sql(source: str, keys: str) -> str:
    """A select that adds the sixteen derived columns to a relation holding the nine sums."""
    first = []
    for m in ("stotal", "people_in", "checkout"):
        now, before = f"year0_{m}", f"year0_minus_1_{m}"
        first.append(f"CAST({now} - {before} AS BIGINT) AS {m}_net")
        first.append(f"{_ratio(f'({now} - {before})', before, ' * 100')} AS {m}_pct")
    for y in _YEARS:
        first.append(f"{_ratio(f'{y}_checkout', f'{y}_people_in', ' * 100')} AS {y}_conversion")
        first.append(f"{_ratio(f'{y}_stotal', f'{y}_checkout')} AS {y}_basket")
    second = []
    for r in ("conversion", "basket"):
        now, before = f"year0_{r}", f"year0_minus_1_{r}"
        second.append(f"CAST({now} - {before} AS BIGINT) AS {r}_net")
        second.append(f"{_ratio(f'({now} - {before})', before, ' * 100')} AS {r}_pct")
    return (
        f"SELECT *, {', '.join(second)} FROM (SELECT {keys}{', ' if keys else ''}{', '.join(SUMS)}, "
        f"{', '.join(first)} FROM {source})"
    )


# ---- stock --------------------------------------------------------------------------------------

# Own codes are the part keys moved by 100, so both sides hold codes the other lacks.
STOCK_SQL = """
supplier_stock AS (
  SELECT CASE WHEN p_partkey % 401 <> 0 THEN CAST(7000000000 + p_partkey AS VARCHAR) || CASE WHEN p_partkey % 3 = 0 THEN '.0' ELSE '' END END AS barcode,
    CASE WHEN p_size % 7 <> 6 THEN p_size % 5 + 0.75 * (p_size % 2) END::DOUBLE AS quantity, p_brand AS brand
  FROM part),
own_stock AS (
  SELECT CASE WHEN l_partkey % 403 <> 0 THEN lpad(CAST(7000000100 + l_partkey AS VARCHAR), 12, '0') END AS barcode,
    CAST(CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) % 5 AS DOUBLE) AS quantity,
    'name ' || CAST(l_partkey AS VARCHAR) AS name, 'n' || CAST(l_partkey % 9 AS VARCHAR) AS short_name
  FROM lineitem GROUP BY l_partkey)"""


def supplier_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    code = F.concat((key + 7_000_000_000).cast("string"), F.when(key % 3 == 0, ".0").otherwise(""))
    quantity = F.col("p_size") % 5 + F.lit(0.75) * (F.col("p_size") % 2)
    return table(spark, sf_dir, "part").select(
        F.when(key % 401 != 0, code).alias("barcode"),
        F.when(F.col("p_size") % 7 != 6, quantity).cast("double").alias("quantity"),
        F.col("p_brand").alias("brand"),
    )


def own_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("l_partkey")
    per_part = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("_q")
    )
    return per_part.select(
        F.when(key % 403 != 0, F.lpad((key + 7_000_000_100).cast("string"), 12, "0")).alias("barcode"),
        (F.col("_q") % 5).cast("double").alias("quantity"),
        F.concat(F.lit("name "), key.cast("string")).alias("name"),
        F.concat(F.lit("n"), (key % 9).cast("string")).alias("short_name"),
    )


# Supplier code -> own code for the first parts.
EXCEPTIONS = {f"00700000000{i}": f"00700000020{i}" for i in range(1, 6)}
EXCEPTIONS_SQL = "exceptions(from_code, to_code) AS (VALUES " + ", ".join(
    f"('{k}', '{v}')" for k, v in EXCEPTIONS.items()
) + ")"
CLEAN_SQL = "lpad(CAST(CAST(floor(CAST(barcode AS DECIMAL(30, 6))) AS BIGINT) AS VARCHAR), 12, '0')"

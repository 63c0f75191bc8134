"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from retailgrain.checks import standins as s
from retailgrain.checks.columns import PRICE_CASE, QUANTITY_CASE
from retailgrain.checks.registry import check
from retailgrain.functions import city_group
from retailgrain.operators import aggregates as agg
from retailgrain.operators.reshape import periods_to_columns
from retailgrain.operators.yoy import SUM_METRICS
from retailgrain.plans.order_cube import CUBE_DIMS, order_cube
from retailgrain.plans.stock_recon import MatchLabels, recon_summary, reconcile
from retailgrain.plans.weekly_orders import DETAIL_DIMS, detail_dims, order_groups, weekly_metrics
from retailgrain.plans.yoy_sales import fact_sums, sales_scopes
from retailgrain.rules.fixed_values import QUANTITY_BUCKETS, metric_rules, price_buckets
from retailgrain.rules.tables import barcode_table

LABELS = MatchLabels("matched", "theirs only", "ours only")
SUMS = list(SUM_METRICS)


@check("agg_group_count", f"""
WITH {s.LINES_SQL}
SELECT order_no, strftime(order_date, '%Y-%m-%d') AS order_day, order_status, delivery, address, product, price,
  supplier_article_id, line_count FROM lines""")
def agg_group_count(spark, sf):
    return s.lines(spark, sf).select(
        "order_no", F.to_date("order_date").cast("string").alias("order_day"), "order_status", "delivery", "address",
        "product", "price", "supplier_article_id", "line_count",
    )


@check("agg_group_sum_fact", f"WITH {s.FACT_SQL} SELECT * FROM fact")
def agg_group_sum_fact(spark, sf):
    return fact_sums(s.facts(spark, sf)).withColumn("month", F.col("month").cast("bigint"))


@check("agg_region_channel", f"""
WITH {s.FACT_SQL}
SELECT region, channel, {s.sums_sql()} FROM fact
WHERE month = 6 AND company = 'A' AND region IS NOT NULL AND channel IS NOT NULL GROUP BY 1, 2""")
def agg_region_channel(spark, sf):
    main = fact_sums(s.facts(spark, sf)).where((F.col("month") == 6) & (F.col("company") == "A"))
    return agg.group_sums(main, ["region", "channel"], SUMS)


@check("agg_global", f"WITH {s.FACT_SQL} SELECT {s.sums_sql()} FROM fact WHERE company = 'A'")
def agg_global(spark, sf):
    return agg.group_sums(fact_sums(s.facts(spark, sf)).where(F.col("company") == "A"), [], SUMS)


@check("agg_by_channel", f"""
WITH {s.FACT_SQL}
SELECT channel, {s.sums_sql()} FROM fact WHERE region IN ('AFRICA', 'AMERICA', 'ASIA') AND channel IS NOT NULL GROUP BY 1""")
def agg_by_channel(spark, sf):
    shops = fact_sums(s.facts(spark, sf)).where(F.col("region").isin(*s.SCOPES.shop_regions))
    return agg.group_sums(shops, ["channel"], SUMS)


@check("agg_by_region", f"""
WITH {s.FACT_SQL} SELECT region, {s.sums_sql()} FROM fact WHERE region IS NOT NULL GROUP BY 1""")
def agg_by_region(spark, sf):
    return agg.group_sums(fact_sums(s.facts(spark, sf)), ["region"], SUMS)


CITY_GROUP_SQL = """CASE WHEN contains(lower(shop_name), 'nation_1') THEN 'Vilnius'
  WHEN contains(lower(shop_name), 'nation_2') THEN 'Kaunas' ELSE 'Kiti miestai' END"""


@check("agg_reclassify", f"""
WITH {s.FACT_SQL},
by_shop AS (SELECT shop_name, {s.sums_sql()} FROM fact WHERE shop_name IS NOT NULL GROUP BY 1)
SELECT {CITY_GROUP_SQL} AS city_group, {s.sums_sql()} FROM by_shop GROUP BY 1""")
def agg_reclassify(spark, sf):
    named = fact_sums(s.facts(spark, sf)).where(F.col("shop_name").isNotNull())
    grouped = named.withColumn("city_group", city_group(F.col("shop_name"), s.SCOPES.city_groups))
    return agg.group_sums(grouped, ["city_group"], SUMS)


def _section(name: str, where: str, key: str = "NULL", subkey: str = "NULL", source: str = "fact") -> str:
    group = " GROUP BY " + ", ".join(k for k in (key, subkey) if k != "NULL") if key != "NULL" else ""
    having = "" if key != "NULL" else " HAVING count(*) > 0"
    return (
        f"SELECT '{name}' AS section, CAST({key} AS VARCHAR) AS key, CAST({subkey} AS VARCHAR) AS subkey, "
        f"{s.sums_sql()} FROM {source} WHERE {where}{group}{having}"
    )


_SHOPS = "region IN ('AFRICA', 'AMERICA', 'ASIA')"
SECTIONS_SQL = f"""{s.FACT_SQL},
main AS MATERIALIZED (SELECT region, channel, {s.sums_sql()} FROM fact
  WHERE month = 6 AND company = 'A' AND region IS NOT NULL AND channel IS NOT NULL GROUP BY 1, 2),
by_shop AS (SELECT {CITY_GROUP_SQL} AS city_group, {s.sums_sql()} FROM fact
  WHERE month = 6 AND {_SHOPS} AND shop_name IS NOT NULL GROUP BY 1),
shop_channels AS (SELECT channel, {", ".join(f"CASE WHEN {_SHOPS} THEN {m} END AS {m}" for m in s.SUMS)} FROM main),
sections AS MATERIALIZED (
{_section("region_channel", "true", "region", "channel", "main")} UNION ALL
{_section("shops_in_month", _SHOPS, source="main")} UNION ALL
{_section("shops_to_date", _SHOPS + " AND channel IS NOT NULL")} UNION ALL
{_section("online", "region = 'EUROPE'", "channel", source="main")} UNION ALL
{_section("online_to_date", "region = 'EUROPE'")} UNION ALL
{_section("b2b", "region = 'MIDDLE EAST'", source="main")} UNION ALL
{_section("other_channels_to_date", "region = 'MIDDLE EAST'")} UNION ALL
{_section("group_in_month", "true", source="main")} UNION ALL
{_section("group_to_date", "company = 'A'")} UNION ALL
{_section("shops_by_region", _SHOPS, "region", source="main")} UNION ALL
{_section("shops_by_channel", "true", "channel", source="shop_channels")} UNION ALL
{_section("city_groups", "true", "city_group", source="by_shop")})"""


@check("agg_scopes", f"WITH {SECTIONS_SQL} SELECT * FROM sections")
def agg_scopes(spark, sf):
    fact = fact_sums(s.facts(spark, sf))
    cut = fact.withColumn("city_group", city_group(F.col("shop_name"), s.SCOPES.city_groups))
    return agg.scope_sums(cut, sales_scopes(s.SCOPES), SUMS)


CITY_SQL = """CASE WHEN contains(lower(address), 'nation_1') THEN 'One' WHEN contains(lower(address), 'nation_2') THEN 'Two'
  WHEN contains(lower(address), 'asia') THEN 'Asian' WHEN contains(lower(address), 'nation_3') THEN 'Three'
  ELSE 'Elsewhere' END"""
CUBE_SQL = f"""{s.LINES_SQL},
tagged AS (SELECT *, CAST(weekofyear(order_date) AS BIGINT) AS iso_week,
  strftime(week_start, '%m-%d') || ' iki ' || strftime(week_start + INTERVAL 6 DAY, '%m-%d') AS week_label,
  {CITY_SQL} AS city, {PRICE_CASE.format(x='price')} AS price_bucket, {QUANTITY_CASE.format(x='line_count')} AS quantity_bucket FROM lines),
cube_cells AS (SELECT week_start, iso_week, week_label, channel, order_status, city, delivery, product, price_bucket, quantity_bucket,
  sum(CAST(price AS DECIMAL(28,6))) AS price_sum, count(*) AS n, sum(line_count) AS line_count,
  sum(order_weight) AS order_weight, sum(CAST(line_total AS DECIMAL(28,6))) AS total_sum
  FROM tagged WHERE order_status IS NOT NULL AND delivery IS NOT NULL AND product IS NOT NULL AND price_bucket IS NOT NULL
  GROUP BY ALL)"""


CUBE_TABLE_SQL = f"""
WITH {CUBE_SQL}
SELECT iso_week AS "Savaite", week_label AS "Savaites_xx_xx", channel AS "Eshop", order_status AS "Uzsakymo_busena",
  city AS "Miestas", delivery AS "Atsiemimas", product AS "Preke", price_bucket AS "PriceBucket",
  quantity_bucket AS "QuantityBucket", price_sum::DOUBLE / n AS "Galutine_kaina",
  CAST(line_count AS DOUBLE) AS "Kiekis_uzsakymu", floor(order_weight * 1e6 + 0.5) / 1e6 AS "Apsipirkimu_kiekis",
  total_sum::DOUBLE AS "Bendra_suma" FROM cube_cells"""


@check("agg_cube_rollup", f"""
WITH {CUBE_SQL}
SELECT CAST(week_start AS VARCHAR) AS week_start, iso_week, week_label, channel, order_status, city, delivery, product,
  price_bucket, quantity_bucket, price_sum::DOUBLE / n AS mean_price, CAST(line_count AS BIGINT) AS line_count,
  floor(order_weight * 1e6 + 0.5) / 1e6 AS order_weight, total_sum::DOUBLE AS line_total FROM cube_cells""")
def agg_cube_rollup(spark, sf):
    cube = order_cube(s.lines(spark, sf), s.CITY_RULES, price_buckets(), QUANTITY_BUCKETS, s.OTHER_CITY)
    return cube.withColumns({
        "week_start": F.col("week_start").cast("string"),
        "iso_week": F.col("iso_week").cast("bigint"),
        "order_weight": s.micro(F.col("order_weight")),
    }).select("week_start", *CUBE_DIMS, "mean_price", "line_count", "order_weight", "line_total")


DETAIL_SQL = f"""{s.LINES_SQL},
detail AS (SELECT week_start, is_weekend, replace(address, 'g.', 'g. ') AS address, order_status, channel, delivery,
  CAST(sum(line_count) AS BIGINT) AS line_count, CAST(floor(sum(order_weight) + 1e-9) AS BIGINT) AS orders
  FROM lines WHERE address IS NOT NULL AND order_status IS NOT NULL AND delivery IS NOT NULL GROUP BY ALL)"""


@check("agg_detail_dims", f"""
WITH {DETAIL_SQL} SELECT * REPLACE (CAST(week_start AS VARCHAR) AS week_start) FROM detail""")
def agg_detail_dims(spark, sf):
    detail = detail_dims(order_groups(s.lines(spark, sf)))
    return detail.withColumn("week_start", F.col("week_start").cast("string")).select(
        *DETAIL_DIMS, "line_count", "orders"
    )


_METRIC_SQL = {
    "Gauta užsakymų": "true",
    "Atšauktų": "order_status = 'canceled'",
    "Eksportuoti": "order_status = 'ORDEFOLDER_PREPARING'",
    "Paruošta atsiėmimui": "order_status IN ('holded', 'ORDEFOLDER_READYTOTAKE')",
    "Nauji": "order_status = 'processing'",
    "Laukia apmokėjimo": "order_status = 'wait_payment'",
    "Užbaigti": "order_status IN ('complete', 'ORDEFOLDER_COMPLETE')",
    "Skubus į namus": "delivery = 'LP Express'",
    "Skubus C&C": "delivery IN ('atsiemimas parduotuve ', 'atsiemimas parduotuveje')",
    "Parduotuvėms perduota po darbo valandų": "true",
    "Atsiėmimas parduotuvėje": "delivery = 'atsiemimas parduotuveje'",
    "Pristatymas nurodytu adresu ": "lower(trim(delivery)) = 'pristatymas i namus'",
    "Omniva": "contains(lower(delivery), 'omniva')",
    "LP Express": "delivery = 'LP Express'",
    "DPD terminalas": "delivery = 'DPD terminalas'",
    "Savitarna": "delivery = 'DPD terminalas'",
}
_PICKUP = "lower(trim(delivery)) IN ('atsiemimas parduotuveje', 'atsiemimas parduotuve', 'savitarna')"
_A = "lower(trim(address))"
_SHOP_SQL = {
    "Nation_1, One": f"contains({_A}, 'nation_1')",
    "nation_11 g. 7, Eleven": f"contains({_A}, 'nation_11 g. 7')",
    "Nation_2, Asia": f"contains({_A}, 'nation_2') AND contains({_A}, 'asia')",
    "NATION_5 g. 3 , Five": f"{_A} = 'nation_5 g. 3'",
    "nation_12 g. 1, America": f"contains({_A}, 'nation_12 g. 1') AND contains({_A}, 'america')",
    "nation_10 g. 25, nation_10": f"{_A} = 'nation_10 g. 25'",
}


def _weekly_sql(rules: dict[str, str]) -> str:
    """One select per metric and period kind over the detail rows."""
    parts = []
    for name, cond in rules.items():
        for kind, flag in (("week", "true"), ("weekend", "is_weekend")):
            parts.append(
                f"SELECT week_start, '{kind}' AS period_kind, '{name}' AS metric, "
                f"CAST(sum(CASE WHEN {flag} AND ({cond}) THEN orders ELSE 0 END) AS BIGINT) AS value FROM detail GROUP BY week_start"
            )
    return " UNION ALL ".join(parts)


_SHOP_RULES_SQL = {name: f"{_PICKUP} AND {cond}" for name, cond in _SHOP_SQL.items()}
WEEKLY_SQL = f"{DETAIL_SQL}, weekly AS ({_weekly_sql({**_METRIC_SQL, **_SHOP_RULES_SQL})})"
METRICS_SQL = f"{DETAIL_SQL}, weekly AS ({_weekly_sql(_METRIC_SQL)})"
SHOPS_SQL = f"{DETAIL_SQL}, weekly AS ({_weekly_sql(_SHOP_RULES_SQL)})"


@check("agg_conditional", f"""
WITH {METRICS_SQL} SELECT metric, period_kind, CAST(sum(value) AS BIGINT) AS value FROM weekly GROUP BY 1, 2""")
def agg_conditional(spark, sf):
    weekly = weekly_metrics(s.lines(spark, sf), metric_rules())
    return weekly.groupBy("metric", "period_kind").agg(F.sum("value").alias("value"))


@check("agg_shop_pivot", f"""
WITH {SHOPS_SQL}
SELECT CAST(week_start AS VARCHAR) AS week_start, {", ".join(f"sum(value) FILTER (metric = '{n}')::BIGINT AS shop_{i}" for i, n in enumerate(_SHOP_SQL))}
FROM weekly WHERE period_kind = 'week' GROUP BY 1""")
def agg_shop_pivot(spark, sf):
    weekly = weekly_metrics(s.lines(spark, sf), (), s.SHOP_RULES).where(F.col("period_kind") == "week")
    labels = [r.label for r in s.SHOP_RULES]
    wide = periods_to_columns(weekly.withColumn("week_start", F.col("week_start").cast("string")), "week_start", "metric", labels)
    return wide.toDF("week_start", *[f"shop_{i}" for i in range(len(labels))])


@check("agg_week", f"""
WITH {WEEKLY_SQL} SELECT CAST(week_start AS VARCHAR) AS week_start, period_kind, metric, value FROM weekly""")
def agg_week(spark, sf):
    weekly = weekly_metrics(s.lines(spark, sf), metric_rules(), s.SHOP_RULES)
    return weekly.select(F.col("week_start").cast("string").alias("week_start"), "period_kind", "metric", "value")


@check("agg_week_distinct", f"""
WITH {s.LINES_SQL},
kept AS (SELECT * FROM lines WHERE order_status IS NOT NULL AND delivery IS NOT NULL AND address IS NOT NULL AND order_no IS NOT NULL)
SELECT CAST(week_start AS VARCHAR) AS week_start, count(DISTINCT order_no) AS orders,
  count(DISTINCT CASE WHEN order_status = 'canceled' THEN order_no END) AS canceled,
  count(DISTINCT CASE WHEN is_weekend THEN order_no END) AS weekend_orders FROM kept GROUP BY 1""")
def agg_week_distinct(spark, sf):
    rules = metric_rules()
    weekly = weekly_metrics(s.lines(spark, sf), rules, counting="distinct")
    week, total, canceled = F.col("period_kind") == "week", F.col("metric") == rules[0].metric, F.col("metric") == rules[1].metric
    return weekly.groupBy(F.col("week_start").cast("string").alias("week_start")).agg(
        F.sum(F.when(week & total, F.col("value"))).alias("orders"),
        F.sum(F.when(week & canceled, F.col("value"))).alias("canceled"),
        F.sum(F.when(~week & total, F.col("value"))).alias("weekend_orders"),
    )


RECON_SQL = f"""{s.STOCK_SQL},{s.EXCEPTIONS_SQL},
clean AS (SELECT coalesce(to_code, code) AS barcode, quantity, brand FROM
  (SELECT {s.CLEAN_SQL} AS code, quantity, brand FROM supplier_stock WHERE barcode IS NOT NULL) LEFT JOIN exceptions ON code = from_code),
own AS (SELECT barcode AS own_barcode, quantity AS own_quantity, name AS own_name, short_name AS own_short_name, 1 AS is_own FROM own_stock),
joined AS (SELECT barcode, coalesce(quantity, 0) AS quantity, brand, own_barcode, coalesce(own_quantity, 0) AS own_quantity, own_name, own_short_name,
  CASE WHEN is_own IS NULL THEN 'theirs only' WHEN is_theirs IS NULL THEN 'ours only' ELSE 'matched' END AS match_type
  FROM (SELECT *, 1 AS is_theirs FROM clean) FULL OUTER JOIN own ON barcode = own_barcode),
recon AS (SELECT *, CAST(trunc(own_quantity) AS BIGINT) - CAST(trunc(quantity) AS BIGINT) AS diff FROM joined
  WHERE NOT (match_type = 'theirs only' AND trunc(quantity) = 0) AND NOT (match_type = 'ours only' AND trunc(own_quantity) = 0))"""


def recon(spark, sf, **kwargs):
    exceptions = barcode_table(spark, s.EXCEPTIONS)
    return reconcile(s.supplier_stock(spark, sf), s.own_stock(spark, sf), exceptions, LABELS, **kwargs)


SUMMARY_SQL = """SELECT count(*) AS rows_total, count(*) FILTER (match_type = 'matched') AS matched,
  count(*) FILTER (match_type = 'theirs only') AS supplier_only, count(*) FILTER (match_type = 'ours only') AS own_only,
  CAST(coalesce(sum(abs(diff)) FILTER (match_type = 'matched'), 0) AS BIGINT) AS units_mismatched,
  count(*) FILTER (match_type = 'matched' AND diff > 0) AS surplus_rows,
  count(*) FILTER (match_type = 'matched' AND diff < 0) AS shortage_rows,
  CAST(round_even(count(*) FILTER (match_type = 'matched')::DOUBLE / count(*) * 100, 0) AS BIGINT) AS matched_pct,
  CAST(round_even(count(*) FILTER (match_type = 'theirs only')::DOUBLE / count(*) * 100, 0) AS BIGINT) AS supplier_only_pct,
  CAST(round_even(count(*) FILTER (match_type = 'ours only')::DOUBLE / count(*) * 100, 0) AS BIGINT) AS own_only_pct"""


@check("agg_recon_summary", f"WITH {RECON_SQL} {SUMMARY_SQL} FROM recon")
def agg_recon_summary(spark, sf):
    return recon_summary(recon(spark, sf, expand=False, ordered=False), LABELS)


@check("agg_max", "SELECT strftime(max(l_shipdate), '%Y-%m-%d') AS last_day FROM lineitem")
def agg_max(spark, sf):
    last = F.date_format(F.max("l_shipdate"), "yyyy-MM-dd").alias("last_day")
    return s.table(spark, sf, "lineitem").agg(last)


@check("agg_distinct_values", f"WITH {s.FACTS_SQL} SELECT DISTINCT channel FROM facts WHERE channel IS NOT NULL")
def agg_distinct_values(spark, sf):
    return s.facts(spark, sf).select("channel").dropna().distinct()

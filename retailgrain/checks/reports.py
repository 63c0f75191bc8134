"""The four reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from retailgrain.checks import standins as s
from retailgrain.checks.aggregates import CITY_SQL, CUBE_TABLE_SQL, LABELS, RECON_SQL, SECTIONS_SQL, SUMMARY_SQL, WEEKLY_SQL, recon
from retailgrain.checks.registry import check
from retailgrain.checks.windows import CHANGE_SQL, PCT_CHANGE_SQL
from retailgrain.functions.matching import normalized
from retailgrain.operators.windows import period_change
from retailgrain.operators.yoy import CONVERSIONS, BASKETS, DERIVED_METRICS, RATIO_METRICS, SUM_METRICS
from retailgrain.plans.order_cube import order_cube, to_cube_table
from retailgrain.plans.stock_recon import recon_summary
from retailgrain.plans.weekly_orders import week_beside_weekend, weekly_metrics, weekly_report, weekly_shop_metrics, weekly_table
from retailgrain.plans.yoy_sales import fact_sums, yoy_bundle, yoy_report
from retailgrain.rules.fixed_values import OTHER_CITIES, QUANTITY_BUCKETS, city_rules, metric_rules, price_buckets, shop_rules
from retailgrain.rules.tables import rule_table

_NAMES = [*[r.metric for r in metric_rules()], *[r.label for r in s.SHOP_RULES]]
_MONDAY = "week_start"
WEEK_LABELS_SQL = f"""CASE WHEN period_kind = 'week' THEN strftime({_MONDAY}, '%m-%d') ELSE strftime({_MONDAY} + INTERVAL 4 DAY, '%m-%d') END
  || ' iki ' || strftime({_MONDAY} + INTERVAL 6 DAY, '%m-%d')"""


@check("report_weekly_orders", f"""
WITH {CHANGE_SQL}
SELECT CAST(week_start AS VARCHAR) AS week_start, CAST(weekofyear(week_start) AS BIGINT) AS iso_week,
  {WEEK_LABELS_SQL} AS label, period_kind, metric, value, {PCT_CHANGE_SQL} FROM changed""")
def report_weekly_orders(spark, sf):
    report = weekly_report(s.lines(spark, sf), metric_rules(), s.SHOP_RULES)
    return report.withColumns({
        "week_start": F.col("week_start").cast("string"), "iso_week": F.col("iso_week").cast("bigint"),
    })


@check("report_weekly_table", f"""
WITH {WEEKLY_SQL}
SELECT CAST(week_start AS VARCHAR) AS week_start, CAST(weekofyear(week_start) AS BIGINT) AS iso_week,
  strftime(week_start + INTERVAL 4 DAY, '%m-%d') || ' iki ' || strftime(week_start + INTERVAL 6 DAY, '%m-%d') AS label,
  {", ".join(f"CAST(sum(value) FILTER (metric = '{name}') AS BIGINT) AS metric_{i}" for i, name in enumerate(_NAMES))}
FROM weekly WHERE period_kind = 'weekend' GROUP BY week_start""")
def report_weekly_table(spark, sf):
    metrics = weekly_metrics(s.lines(spark, sf), metric_rules(), s.SHOP_RULES)
    table = weekly_table(metrics, _NAMES, "weekend").withColumns({
        "week_start": F.col("week_start").cast("string"), "iso_week": F.col("iso_week").cast("bigint"),
    })
    return table.toDF("week_start", "iso_week", "label", *[f"metric_{i}" for i in range(len(_NAMES))])


@check("report_weekly_shops", f"""
WITH {WEEKLY_SQL}
SELECT CAST(week_start AS VARCHAR) AS week_start, CAST(weekofyear(week_start) AS BIGINT) AS iso_week, {WEEK_LABELS_SQL} AS label, period_kind, metric, value FROM weekly
WHERE metric IN ({", ".join(f"'{r.label}'" for r in s.SHOP_RULES)})""")
def report_weekly_shops(spark, sf):
    return _dated(weekly_shop_metrics(s.lines(spark, sf), rule_table(spark, s.SHOP_RULES)))


def _dated(rows):
    return rows.withColumns({"week_start": F.col("week_start").cast("string"), "iso_week": F.col("iso_week").cast("bigint")})


@check("report_week_beside_weekend", f"""
WITH {CHANGE_SQL},
told AS (SELECT *, {PCT_CHANGE_SQL} FROM changed)
SELECT CAST(w.week_start AS VARCHAR) AS week_start, CAST(weekofyear(w.week_start) AS BIGINT) AS iso_week, w.metric AS metric,
  w.value AS value, w.pct_change AS pct_change, e.value AS weekend_value, e.pct_change AS weekend_pct_change,
  strftime(w.week_start, '%m-%d') || ' iki ' || strftime(w.week_start + INTERVAL 6 DAY, '%m-%d') AS label,
  strftime(w.week_start + INTERVAL 4 DAY, '%m-%d') || ' iki ' || strftime(w.week_start + INTERVAL 6 DAY, '%m-%d') AS weekend_label
FROM told w JOIN told e ON w.week_start = e.week_start AND w.metric = e.metric AND w.period_kind = 'week' AND e.period_kind = 'weekend'""")
def report_week_beside_weekend(spark, sf):
    return _dated(week_beside_weekend(weekly_metrics(s.lines(spark, sf), metric_rules(), s.SHOP_RULES)))


# The listed shops and cities, on orders that go to them.
_PLACE = "lower(trim(CASE WHEN contains(address, '.') AND NOT contains(trim(address), '. ') THEN replace(address, '.', '. ') ELSE address END))"


def _shop_sql(rule) -> str:
    hit = f"a = '{normalized(rule.address)}'" if rule.equal else f"contains(a, '{normalized(rule.address)}')"
    return f"({hit} AND contains(a, '{normalized(rule.city)}'))" if rule.and_city else hit


_LISTED_SHOPS_SQL = f"""
WITH {s.PLACED_LINES_SQL},
detail AS (SELECT week_start, is_weekend, {_PLACE} AS a, order_status, channel, delivery, CAST(floor(sum(order_weight) + 1e-9) AS BIGINT) AS orders
  FROM lines WHERE address IS NOT NULL AND order_status IS NOT NULL AND delivery IS NOT NULL GROUP BY ALL),
tagged AS (SELECT week_start, is_weekend, orders, lower(trim(delivery)) IN ('atsiemimas parduotuveje', 'atsiemimas parduotuve', 'savitarna') AS picked,
  {", ".join(f"{_shop_sql(r)} AS h{r.ordinal}" for r in shop_rules())} FROM detail),
kinds(period_kind) AS (VALUES ('week'), ('weekend')),
sums AS (SELECT week_start, period_kind, {", ".join(f"CAST(coalesce(sum(orders) FILTER (picked AND h{r.ordinal}), 0) AS BIGINT) AS s{r.ordinal}" for r in shop_rules())}
  FROM (SELECT * FROM tagged, kinds WHERE period_kind = 'week' OR is_weekend) GROUP BY 1, 2),
weeks AS (SELECT DISTINCT week_start, period_kind FROM tagged, kinds),
complete AS MATERIALIZED (SELECT week_start, period_kind, unnest([{", ".join(f"{{'metric': '{r.label}', 'value': coalesce(s{r.ordinal}, 0)}}" for r in shop_rules())}]) AS cell
  FROM weeks LEFT JOIN sums USING (week_start, period_kind)),
weekly AS (SELECT week_start, period_kind, cell.metric AS metric, cell.value AS value FROM complete),
changed AS (SELECT *, lag(value) OVER (PARTITION BY period_kind, metric ORDER BY week_start) AS previous FROM weekly)
SELECT CAST(week_start AS VARCHAR) AS week_start, CAST(weekofyear(week_start) AS BIGINT) AS iso_week, {WEEK_LABELS_SQL} AS label, period_kind, metric, value, {PCT_CHANGE_SQL}
FROM changed"""


@check("report_listed_shops", _LISTED_SHOPS_SQL)
def report_listed_shops(spark, sf):
    """All 33 shops, as rules in the plan."""
    return _dated(weekly_report(s.lines(spark, sf, s.PLACES), (), shop_rules()))


@check("report_listed_shops_table", _LISTED_SHOPS_SQL)
def report_listed_shops_table(spark, sf):
    """The same from a rule table."""
    weekly = weekly_shop_metrics(s.lines(spark, sf, s.PLACES), rule_table(spark, shop_rules()))
    return _dated(period_change(weekly, ["period_kind", "metric"], "week_start"))


def _cities_sql(rules) -> str:
    first = " ".join(f"WHEN contains(lower(trim(address)), '{normalized(r.pattern)}') THEN '{r.city}'" for r in rules)
    city = f"CASE {first} ELSE '{OTHER_CITIES}' END"
    return CUBE_TABLE_SQL.replace(s.LINES_SQL, s.PLACED_LINES_SQL).replace(CITY_SQL, city)


@check("report_listed_cities", _cities_sql(city_rules()))
def report_listed_cities(spark, sf):
    """The order cube by all 104 cities."""
    return _cube_of(spark, sf, city_rules(), "first")


@check("report_listed_cities_longest", _cities_sql(sorted(city_rules(), key=lambda r: (-len(normalized(r.pattern)), r.ordinal))))
def report_listed_cities_longest(spark, sf):
    """The longest name that occurs, from a rule table."""
    return _cube_of(spark, sf, rule_table(spark, city_rules()), "longest")


def _cube_of(spark, sf, cities, strategy):
    cube = order_cube(s.lines(spark, sf, s.PLACES), cities, price_buckets(), QUANTITY_BUCKETS, OTHER_CITIES, strategy)
    return to_cube_table(cube).withColumn("Apsipirkimu_kiekis", s.micro(F.col("Apsipirkimu_kiekis")))


@check("report_order_cube", CUBE_TABLE_SQL)
def report_order_cube(spark, sf):
    cube = order_cube(s.lines(spark, sf), s.CITY_RULES, price_buckets(), QUANTITY_BUCKETS, s.OTHER_CITY)
    out = to_cube_table(cube)
    return out.withColumn("Apsipirkimu_kiekis", s.micro(F.col("Apsipirkimu_kiekis")))


_SHARES = ", ".join(
    f"CASE WHEN d.section = 'shops_by_region' THEN CAST(round_even(d.{m}::DOUBLE / nullif(t.{m}, 0) * 100, 0) AS BIGINT) END AS {m}_total_pct"
    for m in SUM_METRICS
)
_DIFFS = ", ".join(
    f"CASE WHEN d.section = 'shops_by_region' THEN CAST(d.{m} - t.{m} AS BIGINT) END AS {m}_vs_total"
    for m in (*CONVERSIONS, *BASKETS)
)
_ALL = [*SUM_METRICS, *DERIVED_METRICS, *[f"{m}_total_pct" for m in SUM_METRICS], *[f"{m}_vs_total" for m in RATIO_METRICS]]
BUNDLE_SQL = f"""
WITH {SECTIONS_SQL},
derived AS MATERIALIZED ({s.derived_sql("sections", "section, key, subkey")}),
complete AS MATERIALIZED (SELECT d.*, {_SHARES}, {_DIFFS} FROM derived d, (SELECT * FROM derived WHERE section = 'shops_in_month') t),
long AS (SELECT section, key, subkey, unnest([{", ".join(f"{{'metric': '{m}', 'value': CAST({m} AS BIGINT)}}" for m in _ALL)}]) AS cell FROM complete)
SELECT section, key, subkey, cell.metric AS metric, cell.value AS value FROM (SELECT section, key, subkey, cell FROM long WHERE cell.value IS NOT NULL)
WHERE section <> 'shops_by_region' OR ends_with(cell.metric, '_pct') OR ends_with(cell.metric, '_vs_total')"""


@check("report_yoy_sales", BUNDLE_SQL)
def report_yoy_sales(spark, sf):
    return yoy_bundle(fact_sums(s.facts(spark, sf)), s.SCOPES)


@check("report_yoy_with_date", f"""
SELECT *, (SELECT strftime(max(o_orderdate), '%Y-%m-%d') FROM orders) AS data_until FROM ({BUNDLE_SQL})""")
def report_yoy_with_date(spark, sf):
    return yoy_report(s.facts(spark, sf), s.SCOPES).withColumn("data_until", F.col("data_until").cast("string"))


@check("reshape_report_bundle", f"""
SELECT section, count(*) AS metric_rows, CAST(sum(value) AS BIGINT) AS checksum FROM ({BUNDLE_SQL}) GROUP BY 1""")
def reshape_report_bundle(spark, sf):
    bundle = yoy_bundle(fact_sums(s.facts(spark, sf)), s.SCOPES)
    return bundle.groupBy("section").agg(F.count(F.lit(1)).alias("metric_rows"), F.sum("value").alias("checksum"))


@check("report_stock_recon", f"""
WITH {RECON_SQL}
SELECT barcode, quantity, brand, own_barcode, own_quantity, own_name, own_short_name, match_type, diff FROM recon""")
def report_stock_recon(spark, sf):
    return recon(spark, sf)


@check("report_stock_recon_summary", f"WITH {RECON_SQL} {SUMMARY_SQL} FROM recon")
def report_stock_recon_summary(spark, sf):
    return recon_summary(recon(spark, sf, ordered=False), LABELS)

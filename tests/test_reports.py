"""Reports on hand-made rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from retailgrain.plans import (
    SalesScopes,
    order_cube,
    order_lines,
    recon_summary,
    reconcile,
    weekly_metrics,
    weekly_report,
    weekly_table,
    yoy_sections,
)
from retailgrain.operators.windows import order_weight
from retailgrain.plans.stock_recon import MatchLabels
from retailgrain.rules import MetricRule, ShopRule, barcode_table, rule_table
from retailgrain.rules import fixed_values as fixed

HEADER = (
    "id bigint, company_id int, order_no string, order_date timestamp_ntz, order_status string, payment_status string, "
    "delivery_type string, street string, country string, remark string"
)
DETAIL = "id bigint, header_id bigint, product_id bigint, supplier_article_id string, price double, guarantee string"
TOTAL = [MetricRule("orders")]


def header(i, day, status="complete", delivery="d1", street="Ozo g. 18", company=1000, number="same"):
    number = f"N{i}" if number == "same" else number
    return (i, company, number, dt.datetime.combine(day, dt.time()), status, None, delivery, street, None, None)


def make_lines(spark, headers, details, start, end, **kwargs):
    products = spark.createDataFrame([(1, "lamp"), (2, None)], "id bigint, descr string")
    deliveries = spark.createDataFrame(
        [("d1", 1000, "savitarna"), ("d2", 1000, "LP Express")], "oxid string, trade_network_id int, descr string"
    )
    return order_lines(
        spark.createDataFrame(headers, HEADER), spark.createDataFrame(details, DETAIL), products, deliveries, start, end, **kwargs
    )


MONDAY = dt.date(2020, 12, 28)
END = dt.date(2021, 1, 11)


def one_line_each(headers):
    return [(100 + h[0], h[0], 1, "a", 10.0, None) for h in headers]


def test_statuses_and_range(spark):
    headers = [
        header(1, MONDAY, None), header(2, MONDAY, "wait_payment"), header(3, MONDAY), header(4, END), header(5, MONDAY - dt.timedelta(1)),
    ]
    lines = make_lines(spark, headers, one_line_each(headers), MONDAY, END)
    assert sorted(r.order_no for r in lines.collect()) == ["N1", "N3"]
    both = make_lines(spark, headers, one_line_each(headers), MONDAY, END, closed="both")
    assert sorted(r.order_no for r in both.collect()) == ["N1", "N3", "N4"]


@pytest.mark.parametrize("collapse", [False, True])
def test_lines_are_counted_and_named(spark, collapse):
    headers = [header(1, MONDAY)]
    details = [(1, 1, 1, "a", 5.0, None), (2, 1, 1, "a", 5.0, None), (3, 1, 2, "b", 5.0, None), (4, 1, None, "c", 7.0, None)]
    rows = make_lines(spark, headers, details, MONDAY, END, collapse_first=collapse).collect()
    assert sorted((r.product, r.line_count, r.line_total, r.channel) for r in rows) == [
        ("b", 1, 5.0, "TC"), ("c", 1, 7.0, "TC"), ("lamp", 2, 10.0, "TC"),
    ]


@pytest.mark.parametrize("count", [1, 3, 49, 98, 103])
def test_an_order_weighs_one(spark, count):
    headers = [header(1, MONDAY)]
    details = [(i, 1, 1, "a", float(i), None) for i in range(count)]
    lines = make_lines(spark, headers, details, MONDAY, END)
    week = weekly_metrics(lines, TOTAL).where("period_kind = 'week'").collect()
    assert [r.value for r in week] == [1]
    weighted = order_weight(lines, "order_no").agg(F.sum("order_weight")).first()[0]
    assert weighted == pytest.approx(1.0)


def test_year_crossing_and_change(spark):
    days = [MONDAY] * 2 + [dt.date(2021, 1, 4)] * 5 + [dt.date(2021, 1, 9)] * 2
    headers = [header(i, d) for i, d in enumerate(days)]
    report = weekly_report(make_lines(spark, headers, one_line_each(headers), MONDAY, END), TOTAL)
    rows = report.orderBy("period_kind", "week_start").collect()
    assert [(r.period_kind, r.iso_week, r.label, r.value, r.pct_change) for r in rows] == [
        ("week", 53, "12-28 iki 01-03", 2, None),
        ("week", 1, "01-04 iki 01-10", 7, 250),
        ("weekend", 53, "01-01 iki 01-03", 0, None),
        ("weekend", 1, "01-08 iki 01-10", 2, 0),
    ]


def test_null_delivery_is_left_out(spark):
    headers = [header(1, MONDAY), header(2, MONDAY, delivery="unknown"), header(3, MONDAY, company=2000)]
    lines = make_lines(spark, headers, one_line_each(headers), MONDAY, END)
    assert [r.value for r in weekly_metrics(lines, TOTAL).where("period_kind = 'week'").collect()] == [1]
    cube = order_cube(lines, fixed.city_rules(), fixed.price_buckets(), fixed.QUANTITY_BUCKETS)
    assert cube.agg(F.sum("order_weight")).first()[0] == 1.0


def test_missing_order_number_weighs_nothing(spark):
    headers = [header(1, MONDAY, number=None), header(2, MONDAY)]
    lines = make_lines(spark, headers, one_line_each(headers), MONDAY, END)
    weights = {r.order_no: r.order_weight for r in order_weight(lines, "order_no").collect()}
    assert weights == {None: 0.0, "N2": 1.0}


def test_weight_is_truncated_per_group(spark):
    """One number under two headers with different statuses: both halves are lost, as distinct orders one each."""
    headers = [header(1, MONDAY, "canceled", number="X"), header(2, MONDAY, "complete", number="X")]
    lines = make_lines(spark, headers, one_line_each(headers), MONDAY, END)
    assert [r.value for r in weekly_metrics(lines, TOTAL).where("period_kind = 'week'").collect()] == [0]
    distinct = weekly_metrics(lines, TOTAL, counting="distinct").where("period_kind = 'week'")
    assert [r.value for r in distinct.collect()] == [1]


def test_shop_needs_pickup(spark):
    headers = [header(1, MONDAY, street="Ozo g.18"), header(2, MONDAY, delivery="d2"), header(3, MONDAY, street="Ozo g. 25")]
    lines = make_lines(spark, headers, one_line_each(headers), MONDAY, END)
    shops = [ShopRule(0, "Ozo g. 18", "Vilnius"), ShopRule(1, "Ozo g.", "Vilnius")]
    rows = weekly_metrics(lines, [], shops).where("period_kind = 'week'").collect()
    assert {r.metric: r.value for r in rows} == {"Ozo g. 18, Vilnius": 1, "Ozo g., Vilnius": 2}


def test_cube_cells(spark):
    headers = [header(1, MONDAY, street="Kaunas"), header(2, MONDAY, street="Kaunas")]
    details = [(1, 1, 1, "a", 40.0, None), (2, 1, 1, "a", 40.0, None), (3, 1, 1, "a", 60.0, None), (4, 2, 1, "a", 50.0, None)]
    lines = make_lines(spark, headers, details, MONDAY, END)
    cube = order_cube(lines, fixed.city_rules(), fixed.price_buckets(), fixed.QUANTITY_BUCKETS)
    rows = {(r.price_bucket[:3], r.quantity_bucket[:3]): r for r in cube.collect()}
    assert set(rows) == {("(0)", "(1)"), ("(1)", "(0)"), ("(0)", "(0)")}
    pair = rows[("(0)", "(1)")]
    assert (pair.city, pair.mean_price, pair.line_count, pair.order_weight, pair.line_total) == ("Kaunas", 40.0, 2, 0.5, 80.0)


def test_cube_takes_rules_as_a_table(spark):
    headers = [header(1, MONDAY, street="Kaunas"), header(2, MONDAY, street="Nida")]
    lines = make_lines(spark, headers, one_line_each(headers), MONDAY, END)
    listed, tabled = (
        order_cube(lines, rules, fixed.price_buckets(), fixed.QUANTITY_BUCKETS)
        for rules in (fixed.city_rules(), rule_table(spark, fixed.city_rules()))
    )
    assert sorted(r.city for r in listed.collect()) == sorted(r.city for r in tabled.collect()) == ["Kaunas", "Nida"]


def test_weekly_table(spark):
    headers = [header(1, MONDAY), header(2, dt.date(2021, 1, 4)), header(3, dt.date(2021, 1, 5), "canceled")]
    metrics = weekly_metrics(make_lines(spark, headers, one_line_each(headers), MONDAY, END), fixed.metric_rules())
    table = weekly_table(metrics, ["Gauta užsakymų", "Atšauktų"]).collect()
    assert [(r.iso_week, r["Gauta užsakymų"], r["Atšauktų"]) for r in table] == [(53, 1, 0), (1, 2, 1)]


# ---- stock --------------------------------------------------------------------------------------

LABELS = MatchLabels("both", "theirs", "ours")


def stock(spark, theirs, ours):
    supplier = spark.createDataFrame(theirs, "barcode string, quantity double, note string")
    own = spark.createDataFrame(ours, "barcode string, quantity double, name string, short_name string")
    return supplier, own, barcode_table(spark, fixed.BARCODE_EXCEPTIONS)


def test_reconciliation(spark):
    theirs = [
        ("1", 5.9, "a"), ("2", 3.0, "b"), ("3", 0.0, "zero orphan"), ("4", None, "null orphan"), (None, 9.0, "no code"),
        ("7117194551", 1.0, "mapped"), ("1", 5.9, "a"), ("8", 2.0, "c"),
    ]
    ours = [
        ("000000000001", 9.0, "one", "1"), ("000000000002", 1.0, "two", "2"), ("711719455165", 1.0, "map", "m"),
        (None, 4.0, "no code", "n"), ("000000000077", 0.0, "gone", "g"),
    ]
    rows = reconcile(*stock(spark, theirs, ours), LABELS).collect()
    got = [(r.barcode, r.match_type, r["diff"], r.note) for r in rows]
    assert got[0] in [("000000000001", "both", 4, "a"), (None, "ours", 4, None)]
    assert sorted(got, key=str) == sorted([
        ("000000000001", "both", 4, "a"), ("000000000001", "both", 4, "a"), ("000000000002", "both", -2, "b"),
        ("711719455165", "both", 0, "mapped"), (None, "ours", 4, None), ("000000000008", "theirs", -2, "c"),
    ], key=str)
    assert [abs(d) for _, _, d, _ in got] == sorted((abs(d) for _, _, d, _ in got), reverse=True)


@pytest.mark.parametrize("expand", [True, False])
def test_recon_summary(spark, expand):
    theirs = [("1", 5.0, "a"), ("1", 5.0, "a"), ("2", 3.0, "b"), ("8", 2.0, "c")]
    ours = [("000000000001", 9.0, "one", "1"), ("000000000002", 1.0, "two", "2"), ("000000000005", 4.0, "x", "x")]
    rows = reconcile(*stock(spark, theirs, ours), LABELS, expand=expand)
    s = recon_summary(rows, LABELS).first().asDict()
    assert s == {
        "rows_total": 5, "matched": 3, "supplier_only": 1, "own_only": 1, "units_mismatched": 10, "surplus_rows": 2,
        "shortage_rows": 1, "matched_pct": 60, "supplier_only_pct": 20, "own_only_pct": 20,
    }


def test_empty_summary(spark):
    rows = reconcile(*stock(spark, [], []), LABELS)
    assert set(recon_summary(rows, LABELS).first().asDict().values()) == {0}


def test_only_differences(spark):
    theirs = [("1", 5.0, "a"), ("2", 3.0, "b")]
    ours = [("000000000001", 5.0, "one", "1"), ("000000000002", 1.0, "two", "2")]
    rows = reconcile(*stock(spark, theirs, ours), LABELS, only_differences=True).collect()
    assert [r["diff"] for r in rows] == [-2]


# ---- sales --------------------------------------------------------------------------------------

def fact(spark, rows):
    columns = "month int, region string, company string, channel string, shop_name string, "
    sums = [f"{y}_{m}" for y in ("year0", "year0_minus_1") for m in ("checkout", "people_in", "stotal")]
    rows = spark.createDataFrame(rows, columns + ", ".join(f"{s} bigint" for s in sums))
    zero = F.lit(0).cast("bigint")
    return rows.withColumns({f"year0_minus_2_{m}": zero for m in ("checkout", "people_in", "stotal")})


SCOPES = SalesScopes(company="C", month=3, shop_regions=("S1", "S2"))


def test_sales_sections(spark):
    rows = [
        (3, "S1", "C", "shop", "Vilnius 1", 1, 2, 100, 0, 0, 0),
        (3, "S2", "C", "shop", "Kaunas", 9, 10, 300, 5, 10, 100),
        (3, "S1", "other", "shop", "Vilnius 2", 7, 7, 700, 0, 0, 0),
        (2, "S1", "C", "shop", "Vilnius 1", 4, 8, 50, 0, 0, 0),
        (3, "E-prekyba", "C", "web", None, 2, 4, 80, 0, 0, 0),
        (3, "S1", "C", None, "Vilnius 1", 100, 100, 100, 0, 0, 0),
    ]
    got = {(r.section, r.key, r.subkey): r for r in yoy_sections(fact(spark, rows), SCOPES).collect()}
    shops = got[("shops_in_month", None, None)]
    # Ratios are taken from the sums: 10 / 12.
    assert (shops.year0_stotal, shops.year0_conversion, shops.year0_basket) == (400, 83, 40)
    assert (shops.stotal_net, shops.stotal_pct, shops.people_in_pct) == (300, 300, 20)
    assert shops.year0_stotal_total_pct is None
    first = got[("shops_by_region", "S1", None)]
    assert (first.year0_stotal_total_pct, first.year0_conversion_vs_total) == (25, 50 - 83)
    assert first.stotal_pct == 0  # nothing last year
    assert got[("shops_to_date", None, None)].year0_stotal == 1150
    assert got[("group_in_month", None, None)].year0_stotal == 480
    assert got[("group_to_date", None, None)].year0_stotal == 630
    assert got[("city_groups", "Vilnius", None)].year0_stotal == 900
    # The web channel had no shop rows and is still listed.
    assert got[("shops_by_channel", "web", None)].year0_stotal == 0
    assert got[("online", "web", None)].year0_stotal == 80
    assert ("b2b", None, None) not in got

"""Hand-computed cases for the scalar functions."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from retailgrain import functions as fn
from retailgrain.functions.dates import report_month, report_window
from retailgrain.functions.matching import first_substring, matched_shops
from retailgrain.rules import BucketBound, CityRule, ShopRule
from retailgrain.rules import fixed_values as fixed


def evaluate(spark, expression, values, kind):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def test_half_even(spark):
    assert evaluate(spark, fn.half_even_int, [2.5, 3.5, -2.5, None], "double") == [2, 4, -2, None]


def test_trunc(spark):
    assert evaluate(spark, fn.trunc_int, [1.9, -1.9], "double") == [1, -1]


def test_zero_divisor(spark):
    row = spark.range(1).select(
        fn.safe_ratio_pct(F.lit(5), F.lit(0)), fn.safe_ratio_pct(F.lit(10), F.lit(12)), fn.safe_ratio(F.lit(5), F.lit(2))
    ).first()
    assert tuple(row) == (0, 83, 2)


@pytest.mark.parametrize("kind,values", [
    ("double", [7117194551.0, 43917000237.0, 5901234123457.0, None]),
    ("bigint", [7117194551, 43917000237, 5901234123457, None]),
    ("string", ["7117194551", "43917000237.0", "5901234123457", None]),
])
def test_barcodes(spark, kind, values):
    assert evaluate(spark, fn.normalize_barcode, values, kind) == ["007117194551", "043917000237", "590123412345", None]


def test_text_barcodes(spark):
    values = ["007117194551", " 12 ", "AB.12345678901", "", "123.9"]
    want = ["007117194551", "000000000012", "AB1234567890", None, "000000000123"]
    assert evaluate(spark, fn.normalize_barcode, values, "string") == want


def test_address_spacing(spark):
    values = ["Ozo g.18", "Ozo g. 18", "Ozo g.18. ", "Ozo", None]
    assert evaluate(spark, fn.fix_address_spacing, values, "string") == [
        "Ozo g. 18", "Ozo g. 18", "Ozo g. 18.  ", "Ozo", None,
    ]


def test_join_nullable(spark):
    row = spark.range(1).select(
        fn.join_nullable(F.lit(" a"), F.lit(None).cast("string")), fn.join_nullable(F.lit(None).cast("string"), F.lit("b"))
    ).first()
    assert tuple(row) == ("a", None)


def test_clean_text(spark):
    assert evaluate(spark, fn.clean_text, ["a,b:\tc\n'd' #1.", None], "string") == ["abcd 1", None]


def test_weeks_cross_the_year(spark):
    days = [dt.date(2020, 12, 28), dt.date(2021, 1, 3), dt.date(2021, 1, 4)]
    assert evaluate(spark, fn.iso_week, days, "date") == [53, 53, 1]
    assert evaluate(spark, fn.week_start, days, "date") == [dt.date(2020, 12, 28)] * 2 + [dt.date(2021, 1, 4)]
    assert evaluate(spark, fn.week_label, days[:1], "date") == ["12-28 iki 01-03"]
    assert evaluate(spark, fn.weekend_label, days[:1], "date") == ["01-01 iki 01-03"]


def test_weekend_starts_on_friday(spark):
    days = [dt.date(2021, 1, d) for d in (7, 8, 10, 11)]
    assert evaluate(spark, fn.weekend_flag, days, "date") == [False, True, True, False]


def test_report_window():
    assert report_window(dt.date(2021, 1, 14)) == (dt.date(2020, 11, 2), dt.date(2021, 1, 11))
    assert report_month(dt.date(2021, 3, 1)) == 2


def test_price_buckets(spark):
    values = [50.0, 50.01, 1000.0, 1000.5, None]
    labels = [label for _, label in fixed.PRICE_BUCKETS]
    got = evaluate(spark, lambda c: fn.bucket(c, fixed.price_buckets()), values, "double")
    assert got == [labels[0], labels[1], labels[5], labels[6], None]


def test_quantity_buckets(spark):
    values = [0.0, 1.0, 1.5, 2.0, 3.0, 5.0, 6.0, None]
    labels = [b.label for b in fixed.QUANTITY_BUCKETS]
    got = evaluate(spark, lambda c: fn.bucket(c, fixed.QUANTITY_BUCKETS, fixed.QUANTITY_OTHER), values, "double")
    assert got == ["Error", labels[0], "Error", labels[1], labels[2], labels[2], labels[3], "Error"]


def test_exclusive_bucket_bound(spark):
    bounds = [BucketBound(0, "low", None, 10.0, upper_inclusive=False), BucketBound(1, "high", 10.0, None, lower_inclusive=True)]
    assert evaluate(spark, lambda c: fn.bucket(c, bounds), [9.9, 10.0], "double") == ["low", "high"]


def test_first_city_wins(spark):
    texts = ["Ukmergės g. 240, Vilnius", "  NAUJOJI AKMENĖ", "Nowhere", None, "kaunas"]
    first = evaluate(spark, lambda c: first_substring(c, fixed.city_rules()), texts, "string")
    assert first == ["Ukmergė", "Akmenė", "Kiti miestai", "Kiti miestai", "Kaunas"]
    longest = evaluate(spark, lambda c: first_substring(c, fixed.city_rules(), strategy="longest"), texts, "string")
    assert longest == ["Ukmergė", "Naujoji Akmenė", "Kiti miestai", "Kiti miestai", "Kaunas"]


def test_first_substring_against_python(spark):
    rules = [CityRule(0, "ab", "1"), CityRule(1, "abc", "2"), CityRule(2, "c", "3")]
    texts = ["xabcx", "c", "b", "AB", " bc "]
    want = [next((r.city for r in rules if r.pattern in t.lower().strip()), "-") for t in texts]
    assert evaluate(spark, lambda c: first_substring(c, rules, "-"), texts, "string") == want


def test_an_address_may_match_two_shops(spark):
    rules = [ShopRule(0, "Kęstučio g. 2", "Biržai"), ShopRule(1, "Kęstučio g. 20-1", "Telšiai"), ShopRule(2, "x", "y", equal=True)]
    rows = spark.createDataFrame(
        [("kęstučio g. 20-1, telšiai", "Savitarna "), ("Kęstučio g. 2", "kurjeris"), ("X ", "savitarna"), ("Kęstučio g. 2", None)],
        "address string, delivery string",
    )
    got = [list(r[0]) for r in rows.select(matched_shops(F.col("address"), F.col("delivery"), rules)).collect()]
    assert got == [["Kęstučio g. 2, Biržai", "Kęstučio g. 20-1, Telšiai"], [], ["x, y"], []]


def test_fixed_value_counts():
    assert (len(fixed.CITIES), len(fixed.SHOPS), len(fixed.METRICS), len(fixed.CUBE_COLUMNS)) == (104, 33, 16, 13)
    assert sum(r.equal for r in fixed.shop_rules()) == 1 and sum(r.and_city for r in fixed.shop_rules()) == 5

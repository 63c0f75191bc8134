"""Skew-proof operators against plain ones, and the shape of the plans."""

from __future__ import annotations

import pytest
from pyspark.sql import Window, functions as F

from retailgrain import session, tune
from retailgrain.checks import CHECKS
from retailgrain.operators import skew
from retailgrain.operators.joins import densify, full_outer_match
from retailgrain.operators.projections import tag_first_substring
from retailgrain.operators.rule_joins import shop_pairs_by_join, substring_pairs, tag_by_rules, tag_first_substring_by_join
from retailgrain.operators.skew import PLACE, attach_group_total, chunk_copies, collapse_copies, expand_copies, place, placed
from retailgrain.operators.windows import summed_units, weigh_order_groups
from retailgrain.functions.matching import normalized
from retailgrain.rules import CityRule, ShopRule, rule_table
from retailgrain.rules import fixed_values as fixed


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def hot_rows(spark, n=3000):
    """A third of the rows under one key, a tenth without a key."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None).otherwise((F.col("id") % 500).cast("string"))
    return spark.range(n).select(key.alias("k"), "id", (F.col("id") % 7).alias("v"))


@pytest.mark.parametrize("buckets", [1, 16, None])
def test_group_total_equals_window(spark, buckets):
    df = hot_rows(spark)
    window = df.withColumn("t", F.when(F.col("k").isNotNull(), F.sum("v").over(Window.partitionBy("k"))))
    assert rows_of(attach_group_total(df, ["k"], "v", "t", buckets)) == rows_of(window)


def test_hot_key_is_spread(spark):
    df = hot_rows(spark)
    total = attach_group_total(df.where(F.col("k") == "hot"), ["k"], "v", "t", 16)
    parts = df.where(F.col("k") == "hot").select(F.pmod(F.xxhash64("id", "v"), F.lit(16)).alias("s")).groupBy("s").count()
    assert total.count() == 1000 and parts.count() == 16 and parts.agg(F.max("count")).first()[0] < 120


def partitions_of_exchanges(df) -> list[int]:
    import re

    return [int(n) for n in re.findall(r"hashpartitioning\(.*, (\d+)\), (?:REPARTITION|ENSURE)", plan(df))]


def test_exchanges_grow_with_the_tables(spark, tmp_path, monkeypatch):
    """A number of partitions that stays while the tables grow would make each task sort and group ever more rows."""
    hot_rows(spark, 3000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert skew.spread(df) == skew.spread(spark.createDataFrame([(1,)], "a int")) == few and skew.spread(df, 3) == 3
    window = rows_of(df.withColumn("t", F.when(F.col("k").isNotNull(), F.sum("v").over(Window.partitionBy("k")))))
    sizes = []
    for part in (4096, 1024):
        monkeypatch.setattr(skew, "BYTES_A_PARTITION", part)
        total = attach_group_total(df, ["k"], "v", "t")
        sizes.append(skew.spread(df))
        assert sizes[-1] > few and sizes[-1] in partitions_of_exchanges(total)
        assert rows_of(total) == window
    assert 3.5 < sizes[1] / sizes[0] < 4.5


def test_shuffles_start_with_many_small_partitions(spark):
    """Whatever number the session gives, Spark cuts a shuffle finely, then puts small partitions together and splits hot ones."""
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    with session.settings(spark, {"spark.sql.shuffle.partitions": "12"}):
        tune(spark)
        assert spark.conf.get(initial) == "1000"
        df = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
        assert partitions_of_exchanges(df) == [1000] and df.count() == 7
    with session.settings(spark, {"spark.sql.shuffle.partitions": "3000"}):
        assert tune(spark).conf.get(initial) == "3000"
    assert tune(spark).conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes") == "16m"


@pytest.mark.parametrize("name", [
    "agg_conditional", "agg_detail_dims", "agg_week", "agg_week_distinct", "report_listed_cities", "report_listed_shops", "report_listed_shops_table",
    "report_order_cube", "report_week_beside_weekend", "report_weekly_orders", "report_weekly_table", "win_order_weight", "win_period_change",
])
def test_no_exchange_of_order_lines_has_a_fixed_number(spark, sf_dir, monkeypatch, name):
    """Where the tables read are many times a partition's bytes, no exchange by key keeps to the session's few partitions."""
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(skew, "BYTES_A_PARTITION", 1024)
    counts = partitions_of_exchanges(CHECKS[name].query(tune(spark), sf_dir))
    assert counts and min(counts) >= 10 * few


def test_copies_survive(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("a"), F.when(F.col("id") % 2 == 0, "x").alias("b"))
    collapsed = collapse_copies(df)
    assert collapsed.count() == 6
    assert rows_of(expand_copies(collapsed)) == rows_of(df)
    chunked = chunk_copies(collapsed, chunk=50)
    assert chunked.agg(F.max("copies")).first()[0] == 50 and chunked.count() > 6
    assert rows_of(expand_copies(chunked)) == rows_of(df)


def test_full_outer_equals_builtin(spark):
    left = hot_rows(spark, 300).select(F.col("k").alias("lk"), F.col("id").alias("li"))
    right = spark.range(40).select(
        F.when(F.col("id") == 0, "hot").when(F.col("id") < 4, None).otherwise((F.col("id") * 30 % 700).cast("string")).alias("rk"),
        F.col("id").alias("ri"),
    )
    plain = left.withColumn("l", F.lit(1)).join(right.withColumn("r", F.lit(1)), F.col("lk") == F.col("rk"), "full_outer")
    side = F.when(F.col("l").isNull(), "right").when(F.col("r").isNull(), "left").otherwise("both")
    columns = ["lk", "li", "rk", "ri", "side"]
    assert rows_of(full_outer_match(left, right, "lk", "rk").select(columns)) == rows_of(plain.withColumn("side", side).select(columns))


def addresses(spark):
    base = [f"{c} g. {i}" for i, c in enumerate(fixed.CITIES)] + ["", "a", "Šiauliai, Vilnius", " NIDA ", "Ukmergės g. 1, Kaunas"]
    return spark.createDataFrame([(i, a) for i, a in enumerate([*base, *base, None])], "i int, a string")


@pytest.mark.parametrize("strategy", ["first", "longest"])
def test_rule_table_equals_inlined_rules(spark, strategy):
    df, rules = addresses(spark), fixed.city_rules()
    inlined = tag_first_substring(df, "a", "city", rules, "-", strategy)
    joined = tag_first_substring_by_join(df, "a", "city", rule_table(spark, rules), "-", strategy)
    assert rows_of(inlined) == rows_of(joined.select("i", "a", "city"))


def test_the_callers_type_decides_and_the_result_is_the_same(spark):
    df = addresses(spark)
    listed = tag_by_rules(df, "a", "city", fixed.city_rules())
    assert "Join" not in plan(listed)
    many = [*fixed.city_rules(), *[CityRule(1000 + i, f"no such place {i}", "x") for i in range(600)]]
    for rules in (fixed.city_rules(), many):
        joined = tag_by_rules(df, "a", "city", rule_table(spark, rules))
        assert "Join" in plan(joined) and rows_of(joined.select("i", "a", "city")) == rows_of(listed)


@pytest.mark.parametrize("strategy", ["first", "longest"])
@pytest.mark.parametrize("extra", [0, 600])
def test_padded_equal_empty_and_missing_patterns(spark, strategy, extra):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["abcd", " ABcd ", "xyz", "", None, "ab"])], "i int, a string")
    rules = [CityRule(3, "  ab      ", "padded"), CityRule(2, "abcd", "long"), CityRule(2, "ABCD", "also long"), CityRule(9, " ", "empty"), CityRule(1, None, "missing")]
    rules += [CityRule(100 + i, f"no such place {i}", "x") for i in range(extra)]
    listed = tag_by_rules(df, "a", "c", rules, "-", strategy)
    joined = tag_by_rules(df, "a", "c", rule_table(spark, rules), "-", strategy)
    want = ["also long", "also long", "empty", "empty", "-", "padded"]
    assert [r.c for r in listed.orderBy("i").collect()] == want == [r.c for r in joined.orderBy("i").collect()]


def test_rules_that_begin_alike_do_not_meet_every_text(spark):
    texts = spark.createDataFrame([(f"vilniaus g. {i}",) for i in range(300)], "subject string")
    rules = spark.createDataFrame([(i, f"vilniaus g. {i}x") for i in range(300)], "n int, p string")
    pairs = substring_pairs(texts, rules, "p")
    assert pairs.count() == 0
    made = [int(x) for x in __import__("re").findall(r"number of output rows: (\d+)", pairs._jdf.queryExecution().executedPlan().toString())]
    assert all(n < 20_000 for n in made)


def test_shop_pairs_against_brute_force(spark):
    texts = ["Basanavičiaus g. 6, Jonava", "basanavičiaus g. 6, Kaunas", "algirdo g. 1a, jurbarkas - pc maxima .", "Vytauto g. 17B Prienai ", None]
    df = spark.createDataFrame([(t,) for t in texts], "a string")
    rules = [*fixed.shop_rules(), ShopRule(99, "g", "nowhere")]
    want = set()
    for t in filter(None, map(lambda t: t and normalized(t), texts)):
        for r in rules:
            p = normalized(r.address)
            if (t == p if r.equal else p in t) and (not r.and_city or normalized(r.city) in t):
                want.add((t, r.ordinal))
    assert set(map(tuple, shop_pairs_by_join(df, "a", rule_table(spark, rules)).collect())) == want


def test_patterns_of_all_lengths_against_brute_force(spark):
    letters = "abcabdabeabfacgahiabjkabcdefghijklmnopqrstuvwxyz"
    patterns = sorted({letters[i : i + n] for n in (1, 2, 3, 5, 8, 9, 17, 31, 33, 40) for i in (0, 3, 7)})
    texts = [letters, letters[5:], letters[:20], "xyz", "a", "", letters[3:40] * 2]
    rules = spark.createDataFrame(list(enumerate(patterns)), "n int, p string")
    got = substring_pairs(spark.createDataFrame([(t,) for t in texts], "subject string"), rules, "p")
    want = {(t, n) for t in texts for n, p in enumerate(patterns) if p in t}
    rows = [(r.subject, r.n) for r in got.collect()]
    assert set(rows) == want and len(rows) == len(want)


def test_densify(spark):
    df = spark.createDataFrame([("s1", "a", 5), ("s2", "b", 7)], "section string, key string, v bigint")
    domain = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "key string")
    assert rows_of(densify(df, "section", ["s1", "s2"], "key", domain, ["v"])) == [
        ("s1", "a", 5), ("s1", "b", 0), ("s1", "c", 0), ("s2", "a", 0), ("s2", "b", 7), ("s2", "c", 0),
    ]


# ---- plans --------------------------------------------------------------------------------------

FORBIDDEN = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin")
WRITING = {name for name in CHECKS if name.startswith(("src_", "sink_", "stream_", "snapshot_"))}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(CHECKS) - WRITING))
def test_plan_stays_in_the_engine(spark, sf_dir, name):
    text = plan(CHECKS[name].query(spark, sf_dir))
    assert not [word for word in FORBIDDEN if word in text]
    # Only partial results of an aggregate without keys may meet in one task.
    lines = text.splitlines()
    for above, below in zip(lines, lines[1:]):
        assert "SinglePartition" not in above or "Aggregate(keys=[]" in below


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(CHECKS["src_orders"].query(spark, sf_dir))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    assert "o_orderpriority" not in text


def test_snapshot_reads_one_partition(spark, sf_dir):
    text = plan(CHECKS["src_snapshot"].query(spark, sf_dir))
    assert "PartitionFilters: [isnotnull(snapshot_date" in text


def test_weekly_report_scans_lines_once(spark, sf_dir):
    """Both uses of the order groups come from one exchange."""
    df = CHECKS["agg_detail_dims"].query(spark, sf_dir)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert final.count("l_linenumber") <= 4 and final.count("lineitem.parquet") == 1


@pytest.fixture
def eager_skew(spark):
    """Skew handling that starts at a few kilobytes, and no broadcasts."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_side(spark, n, key, value):
    hot = F.when(F.col("id") % 3 != 0, F.lit(7)).otherwise(F.col("id"))
    return spark.range(0, n, 1, 8).select(hot.alias(key), F.sha1(F.col("id").cast("string")).alias(value))


def final_plan(df) -> str:
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def largest_share(df) -> float:
    """Of all rows, those that one task emits at most."""
    counts = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(counts) / sum(counts)


def test_full_outer_match_splits_a_hot_key(spark, eager_skew):
    left = hot_side(spark, 6000, "lk", "lv")
    right = spark.range(5, 500).select(F.col("id").alias("rk"), F.sha1(F.col("id").cast("string")).alias("rv"))
    matched = full_outer_match(left, right, "lk", "rk", chunk=200)
    plain = left.join(right, F.col("lk") == F.col("rk"), "full_outer")
    assert rows_of(matched.drop("side")) == rows_of(plain)
    assert largest_share(matched.where("lk = 7 and side = 'both'")) < 0.4
    assert largest_share(full_outer_match(left, right, "lk", "rk").where("lk = 7 and side = 'both'")) == 1.0  # within one chunk


@pytest.mark.parametrize("chunk", [1, 7, 100_000])
def test_full_outer_match_where_both_sides_are_hot(spark, chunk):
    left = spark.range(120).select(F.when(F.col("id") < 90, "hot").when(F.col("id") < 100, None).otherwise(F.col("id").cast("string")).alias("a"), F.col("id").alias("x"))
    right = spark.range(200).select(F.when(F.col("id") < 50, "hot").when(F.col("id") < 60, None).otherwise(F.col("id").cast("string")).alias("b"), (F.col("id") % 60).alias("y"))
    plain = left.join(right, F.col("a") == F.col("b"), "full_outer")
    assert rows_of(full_outer_match(left, right, "a", "b", chunk=chunk).drop("side")) == rows_of(plain)
    assert rows_of(full_outer_match(right, left, "b", "a", chunk=chunk).drop("side")) == rows_of(plain.select("b", "y", "a", "x"))


@pytest.mark.parametrize("kind", ["bigint", "double", "date", "timestamp", "boolean", "string", "decimal(10,2)"])
def test_totals_by_keys_of_any_type(spark, kind):
    """What stands for NULL is a key of its own, too."""
    text = {"date": "1970-01-0{}", "timestamp": "1970-01-0{} 00:00:00", "boolean": "false"}.get(kind, "{}")
    df = spark.createDataFrame([(text.format(i % 3 + (kind == "date" or kind == "timestamp")) if i % 4 else None, i) for i in range(40)], "k string, i int")
    df = df.withColumn("k", F.coalesce("k", F.lit(None)).cast(kind))
    window = df.withColumn("t", F.when(F.col("k").isNotNull(), F.sum("i").over(Window.partitionBy("k"))))
    assert rows_of(attach_group_total(df, ["k"], "i", "t")) == rows_of(window)


def scans(df) -> dict[str, int]:
    text = final_plan(df)
    return {name: text.count(f"/{name}.parquet") for name in ("lineitem", "part", "orders") if f"/{name}.parquet" in text}


@pytest.mark.parametrize("name", ["join_full_outer", "report_stock_recon"])
def test_full_outer_match_reads_each_side_once(spark, sf_dir, eager_skew, name):
    assert scans(CHECKS[name].query(spark, sf_dir)) == {"lineitem": 1, "part": 1}


def test_group_count_moves_the_rows_once(spark, sf_dir, eager_skew):
    df = CHECKS["join_group_count"].query(spark, sf_dir)
    assert scans(df) == {"lineitem": 1}
    wide = [line for line in final_plan(df).splitlines() if "REPARTITION_BY_NUM" in line and "ReusedExchange" not in line]
    assert len(wide) == 1


def test_order_lines_split_a_hot_header(spark, eager_skew):
    import datetime as dt

    from retailgrain.plans import order_lines

    headers = spark.range(0, 3000).select(
        "id", F.lit(1000).alias("company_id"), F.col("id").cast("string").alias("order_no"),
        F.lit(dt.datetime(2021, 1, 5)).alias("order_date"), F.lit("complete").alias("order_status"),
        *[F.lit("x").alias(c) for c in ("payment_status", "delivery_type", "street", "country", "remark")],
    )
    details = hot_side(spark, 6000, "header_id", "supplier_article_id").select(
        F.monotonically_increasing_id().alias("id"), "header_id", F.lit(1).alias("product_id"), "supplier_article_id",
        F.lit(2.5).alias("price"), F.lit(None).cast("string").alias("guarantee"),
    )
    products = spark.createDataFrame([(1, None)], "id bigint, descr string")
    deliveries = spark.createDataFrame([("x", 1000, "y")], "oxid string, trade_network_id int, descr string")
    lines = order_lines(headers, details, products, deliveries, dt.date(2021, 1, 4), dt.date(2021, 1, 11))
    assert "skew=true" in final_plan(lines)
    counts = {r.order_no: r.n for r in lines.groupBy("order_no").agg(F.sum("line_count").alias("n")).collect()}
    assert counts["7"] == 4000 and sum(counts.values()) == 4000 + 1000


def test_group_total_of_copies(spark):
    """Equal rows share a sub-key, so copies are combined first."""
    cold = F.col("id") % 300 == 0
    df = spark.range(0, 60000, 1, 8).select(
        F.when(cold, F.col("id")).otherwise(7).alias("k"),
        F.when(cold, F.col("id") % 5).otherwise(1).alias("v"),
    )
    one = collapse_copies(df).withColumn("w", F.col("v") * F.col("copies"))
    total = expand_copies(attach_group_total(one, ["k"], "w", "t").drop("w"))
    assert total.where("k = 7").agg(F.min("t"), F.max("t"), F.count("t")).first()[:] == (59800, 59800, 59800)
    assert total.count() == 60000


def made_exchanges(df) -> list[str]:
    """Exchanges by key that a run made, not those it used again."""
    return [line for line in final_plan(df).splitlines() if "Exchange hashpartitioning" in line and "ReusedExchange" not in line]


@pytest.mark.parametrize("name", ["report_order_cube", "agg_cube_rollup", "report_listed_cities", "report_listed_cities_longest"])
def test_lines_move_once_by_order(spark, sf_dir, eager_skew, name):
    """Grouping lines, counting them by order and matching their texts share one exchange of the lines; no filter or missing column makes a second."""
    made = made_exchanges(CHECKS[name].query(spark, sf_dir))
    assert len([x for x in made if "order_no#" in x]) == 1
    assert len([x for x in made if "REPARTITION_BY_NUM" in x]) == 1


def test_complete_groups_share_the_exchange_of_all(spark, sf_dir, eager_skew):
    made = made_exchanges(CHECKS["agg_detail_dims"].query(spark, sf_dir))
    assert len([x for x in made if "_key0#" in x and "REPARTITION_BY_NUM" in x]) == 1


@pytest.mark.parametrize("name", ["report_weekly_shops", "report_listed_shops_table"])
def test_shops_of_a_rule_table_read_stored_rows(spark, sf_dir, name):
    """All uses of the report rows read the stored ones, none makes the lines again."""
    df = CHECKS[name].query(spark, sf_dir)
    assert "lineitem" not in final_plan(df) and "weekly-detail" in plan(df)


def test_placed_rows_are_not_moved_again(spark, eager_skew):
    df = hot_rows(spark)
    lines = place(df, "k", ["k", "id"], 16).groupBy(*PLACE, "k", "id").agg(F.sum("v").alias("v"))
    total = attach_group_total(lines, ["k"], "v", "t", at=placed(lines)).drop(*PLACE)
    window = df.withColumn("t", F.when(F.col("k").isNotNull(), F.sum("v").over(Window.partitionBy("k"))))
    assert rows_of(total) == rows_of(window)
    assert len([x for x in made_exchanges(total) if "REPARTITION_BY_NUM" in x]) == 1
    hot = place(df.where("k = 'hot'"), "k", ["k", "id"], 16).groupBy(F.spark_partition_id()).count()
    assert hot.count() >= 8 and hot.agg(F.max("count")).first()[0] < 400


def test_units_of_split_orders_add_up(spark):
    """Orders of every size, each row a group: their units make one order, whatever the order of rows, and the rest of a sum stays."""
    df = spark.range(1, 301).select(F.col("id").alias("n"), F.explode(F.sequence(F.lit(1), F.col("id"))).alias("i"))
    df = df.select(F.col("n").cast("string").alias("o"), "n", "i", F.lit(1).cast("bigint").alias("row_count"))
    weighed = weigh_order_groups(df, "o")
    whole, part = summed_units(F.col("part_units"))
    per_order = weighed.groupBy("n").agg((F.sum("whole_orders") + whole + part).alias("w"))
    assert per_order.where("w <> 1.0").count() == 0
    assert weighed.agg((F.sum("whole_orders") + whole + part).alias("w")).first()[0] == 300.0
    third = weighed.where("n = 3 and i = 1 or n = 128 and i < 4").agg((F.sum("whole_orders") + whole + part).alias("w")).first()[0]
    assert third == pytest.approx(1 / 3 + 3 / 128, abs=1e-15)

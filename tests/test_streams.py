"""Stored parts, the order metrics as a stream, and the intake of mixed drops."""

from __future__ import annotations

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from retailgrain.checks import standins as s
from retailgrain.plans import weekly_metrics
from retailgrain.plans.order_lines import LINE_KEYS
from retailgrain.rules.fixed_values import metric_rules
from retailgrain.session import shared_dir
from retailgrain.streaming import (
    OrderMetrics,
    PartStore,
    fold_batches,
    intake_stock_files,
    quarantined_files,
    stored_counts,
    taken_files,
    weekly_counts,
    weekly_counts_stream,
)
from retailgrain.streaming.orders import lines_by_sign


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---- parts --------------------------------------------------------------------------------------


def add(store, batch, value):
    store.commit(batch, [store.stage("t", store.spark.createDataFrame([(batch, value)], "batch int, v int"), batch)])


def test_a_batch_counts_once(spark):
    store = PartStore(spark, shared_dir(spark, "parts"))
    assert store.read("t").count() == 0 and not store.taken(0)
    add(store, 0, 5)
    add(store, 0, 7)  # a replay
    add(store, 1, 6)
    store.stage("t", spark.createDataFrame([(9, 9)], "batch int, v int"), 2)  # a failure before the commit
    assert rows_of(store.read("t")) == [(0, 5), (1, 6)]
    store.vacuum()
    assert rows_of(store.read("t")) == [(0, 5), (1, 6)] and len(store._names("parts/t")) == 2


def test_a_stored_part_leaves_no_shuffle_files(spark, tmp_path, monkeypatch):
    """Parts of one batch are made one after the other; files of all their shuffles would add up on disk."""
    seen = []

    class Rows:
        schema = spark.range(1).schema
        write = property(lambda self: self)

        def parquet(self, path):
            seen.append(spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled"))

    PartStore(spark, str(tmp_path)).stage("t", Rows(), 0)
    assert seen == ["true"]


def test_lines_of_touched_orders_move_once(spark):
    """Each line once, as it was and as it is; one that was not there has no earlier state, one that was has both."""
    line = {c: "x" for c in LINE_KEYS} | {"order_date": dt.datetime(2021, 1, 5), "company_id": 1}
    rows = lambda *counts: spark.createDataFrame([line | {"price": float(k), "line_count": n} for k, n in counts]).withColumn("line_count", F.col("line_count").cast("bigint"))
    signed = lines_by_sign(rows((1, 2), (2, 0)), rows((2, 3), (2, 1), (3, 5)))
    assert rows_of(signed.select("price", "sign", "line_count")) == [(1.0, -1, 2), (1.0, 1, 2), (2.0, -1, 0), (2.0, 1, 4), (3.0, 1, 5)]


def test_batches_beside_a_fold_are_kept_and_a_second_fold_gives_way(spark):
    store = PartStore(spark, shared_dir(spark, "parts"))
    for batch in range(3):
        add(store, batch, 1)
    before = store.read("t")
    outcomes = []

    def fold(rows):
        add(PartStore(spark, store.root), 3, 10)  # while the fold is being written
        if not outcomes:
            outcomes.append("began")
            outcomes.append(PartStore(spark, store.root).fold({"t": lambda r: r.groupBy(F.lit(-2).alias("batch")).agg(F.sum("v").cast("int").alias("v"))}))
        return rows.groupBy(F.lit(-1).alias("batch")).agg(F.sum("v").cast("int").alias("v"))

    assert not store.fold({"t": fold})
    assert outcomes == ["began", True]
    assert rows_of(store.read("t")) == [(-2, 13)]
    assert before.count() == 3  # readers of the older manifest are not disturbed
    add(store, 4, 100)
    assert store.fold({"t": lambda r: r.groupBy(F.lit(-1).alias("batch")).agg(F.sum("v").cast("int").alias("v"))})
    assert rows_of(store.read("t")) == [(-1, 113)]
    [part] = store.manifest().of("t")
    assert (part.first, part.last) == (0, 4)


def test_concurrent_commits_are_all_kept(spark):
    root = shared_dir(spark, "parts")
    PartStore(spark, root)
    errors = []

    def change(table):
        try:
            store = PartStore(spark, root)
            for k in range(4):
                part = store.stage(table, spark.createDataFrame([(k,)], "v int"), k)
                store._publish(lambda now: __import__("dataclasses").replace(now, parts=now.parts + (part[0],), schemas=now.schemas | {table: part[1]}))
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=change, args=(f"t{i}",)) for i in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    store = PartStore(spark, root)
    assert not errors and store.manifest().version == 12
    assert all(store.read(f"t{i}").count() == 4 for i in range(3))


def test_counts_are_folded_while_the_stream_runs(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    folder, out, checkpoint = str(tmp_path / "events"), shared_dir(spark, "weekly"), shared_dir(spark, "ckpt")
    for drop in range(4):
        events.where(F.pmod(F.xxhash64(*events.columns), F.lit(4)) == drop).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        folder_thread = threading.Thread(target=fold_batches, args=(spark, out, ["event_type"]))
        if drop:
            folder_thread.start()
        weekly_counts_stream(spark, stream, "ts", ["event_type"], "value", out, checkpoint, fold_after=3)
        if drop:
            folder_thread.join()
    assert rows_of(stored_counts(spark, out, ["event_type"])) == rows_of(weekly_counts(events, "ts", ["event_type"], "value"))


# ---- orders -------------------------------------------------------------------------------------


def streams(spark, frames, folders):
    return [spark.readStream.schema(rows.schema).parquet(folder) for rows, folder in zip(frames, folders)]


def expected(spark, sf_dir):
    return rows_of(weekly_metrics(s.lines(spark, sf_dir), metric_rules(), s.SHOP_RULES))


@pytest.mark.parametrize("order", ["details first", "headers first", "mixed"])
def test_order_metrics_do_not_depend_on_the_order_of_rows(spark, sf_dir, order):
    headers, details = s.headers(spark, sf_dir), s.details(spark, sf_dir)
    folders = [shared_dir(spark, "headers"), shared_dir(spark, "details")]
    orders = OrderMetrics(spark, shared_dir(spark, "orders"), s.products(spark, sf_dir), s.deliveries(spark), fold_after=3)
    checkpoint = shared_dir(spark, "ckpt")
    odd = F.col("id") % 2 == 1
    nothing = F.lit(False)
    drops = {
        "details first": [(nothing, odd), (nothing, ~odd), (~nothing, nothing)],
        "headers first": [(~nothing, nothing), (nothing, odd), (nothing, ~odd)],
        "mixed": [(odd, F.col("id") % 3 == 0), (nothing, F.col("id") % 3 == 1), (~odd, F.col("id") % 3 == 2)],
    }[order]
    for wanted in drops:
        for rows, folder, some in zip((headers, details), folders, wanted):
            rows.where(some).write.mode("append").parquet(folder)
        orders.run(*streams(spark, (headers, details), folders), checkpoint)
    assert rows_of(orders.metrics(metric_rules(), s.SHOP_RULES)) == expected(spark, sf_dir)
    assert orders.waiting().count() == 0
    parts = orders.store.manifest().parts
    assert all(sum(p.table == t for p in parts) < 4 for t in ("headers", "details", "lines", "shares"))


HEADER_ROW = "id bigint, company_id int, order_no string, order_date timestamp, order_status string, payment_status string, delivery_type string, street string, country string, remark string"
DETAIL_ROW = "id bigint, header_id bigint, product_id bigint, supplier_article_id string, price double, guarantee string"


def header(i, order, day, status="complete"):
    return (i, 1000, order, dt.datetime(2021, 1, day), status, "p", "x", "street", "country", None)


def detail(i, head, article="a", price=1.0):
    return (i, head, None, article, price, None)


@pytest.fixture
def shop(spark):
    products = spark.createDataFrame([], "id bigint, descr string")
    deliveries = spark.createDataFrame([("x", 1000, "y")], "oxid string, trade_network_id int, descr string")
    orders = OrderMetrics(spark, shared_dir(spark, "orders"), products, deliveries)
    batches = iter(range(100))

    def take(headers=(), details=()):
        h, d = spark.createDataFrame(list(headers), HEADER_ROW), spark.createDataFrame(list(details), DETAIL_ROW)
        both = h.select(F.struct(*h.columns).alias("header"), F.lit(None).cast(f"struct<{DETAIL_ROW.replace(' ', ':').replace(',:', ',')}>").alias("detail"))
        both = both.unionByName(d.select(F.lit(None).cast(both.schema["header"].dataType).alias("header"), F.struct(*d.columns).alias("detail")))
        orders.take(both, next(batches))

    return orders, take


def totals(orders):
    return {(r.week_start.day, r.line_count, r.orders) for r in orders.detail().collect()}


def test_late_lines_revise_an_order(shop):
    orders, take = shop
    take([header(1, "A", 4)], [detail(1, 1)])
    assert totals(orders) == {(4, 1, 1)}
    take([header(2, "A", 11)], [detail(2, 2), detail(3, 2, "b")])  # a third of the order lies in one week, the rest in the next
    assert totals(orders) == {(4, 1, 0), (11, 2, 0)}
    take((), [detail(4, 1), detail(5, 7)])  # an equal line and one without a header
    assert totals(orders) == {(4, 2, 0), (11, 2, 0)} and orders.waiting().count() == 1
    take([header(7, None, 4), header(8, "B", 4, "wait_payment")], [detail(6, 8)])
    assert totals(orders) == {(4, 3, 0), (11, 2, 0)} and orders.waiting().count() == 0
    before = totals(orders)
    assert orders.fold() and totals(orders) == before


def test_closed_orders_leave_the_state_and_their_shares_stay(shop):
    orders, take = shop
    take([header(1, "A", 4), header(2, "B", 20), header(3, "B", 5)], [detail(1, 1), detail(2, 2), detail(3, 3)])
    before = totals(orders)
    assert orders.close(dt.date(2021, 1, 15))
    read = lambda table: orders.store.read(table)
    assert sorted(r.header_id for r in read("headers").collect()) == [2, 3] == sorted(r.header_id for r in read("details").collect())
    assert {r.order_no for r in read("lines").collect()} == {"B"} and totals(orders) == before
    take([header(9, "C", 6)], [detail(4, 1), detail(5, 2, "b"), detail(6, 9)])  # late: line 4, header 9 and line 6
    assert totals(orders) != before and orders.late().count() == 0
    assert orders.close(dt.date(2021, 1, 16), wait_batches=0)
    assert sorted(r.header_id for r in orders.late().collect()) == [1, 9, 9]
    assert sorted(r.header_id for r in read("details").collect()) == [2, 2, 3]
    assert orders.store.manifest().notes == {"closed_until": "2021-01-16"}


def test_a_replayed_batch_changes_nothing(shop):
    orders, take = shop
    take([header(1, "A", 4)], [detail(1, 1)])
    before = orders.store.manifest()
    one = orders.spark.createDataFrame([header(5, "Z", 4)], HEADER_ROW).select(F.struct("*").alias("header"), F.lit(None).alias("detail"))
    orders.take(one, 0)
    assert orders.store.manifest() == before


# ---- intake -------------------------------------------------------------------------------------


def drop(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def test_mixed_drops(spark, tmp_path):
    folder, stored, checkpoint = tmp_path / "drop", shared_dir(spark, "stock"), shared_dir(spark, "ckpt")
    drop(folder, "a.csv", "barcode,quantity\n1,5\n2,x\n")
    drop(folder, "b +1.csv", '"note, long", quantity ,barcode\n"n, m",7,3\n')
    drop(folder, "bad.csv", "code,quantity\n9,9\n")
    drop(folder, "empty.csv", "")
    drop(folder, "blank.csv", "\n  \n")
    drop(folder, "head.csv", "barcode,quantity\n")
    rows = intake_stock_files(spark, str(folder), stored, checkpoint)
    assert sorted((r.barcode, r.quantity) for r in rows.collect()) == [("1", 5.0), ("2", None), ("3", 7.0)]
    refused = {r.source_file: (list(r.columns), list(r.missing)) for r in quarantined_files(spark, stored).collect()}
    assert refused == {"bad.csv": (["code", "quantity"], ["barcode"]), "blank.csv": ([], ["barcode", "quantity"])}
    assert {r.source_file: r.row_count for r in taken_files(spark, stored).collect()} == {"a.csv": 2, "b +1.csv": 1, "head.csv": 0}
    drop(folder, "c.csv", "quantity,barcode\nx,2\n5,1\n")
    rows = intake_stock_files(spark, str(folder), stored, checkpoint)
    assert rows.count() == 5
    prints = {r.source_file: r.content_hash for r in taken_files(spark, stored).collect()}
    assert prints["a.csv"] == prints["c.csv"] != prints["b +1.csv"]  # the same rows in another order and layout
    assert quarantined_files(spark, stored).count() == 2


def test_intake_of_nothing(spark, tmp_path):
    (tmp_path / "none").mkdir()
    stored = shared_dir(spark, "stock")
    rows = intake_stock_files(spark, str(tmp_path / "none"), stored, shared_dir(spark, "ckpt"))
    assert rows.columns == ["barcode", "quantity", "source_file", "run_ts"] and rows.count() == 0
    assert taken_files(spark, stored).count() == 0 == quarantined_files(spark, stored).count()

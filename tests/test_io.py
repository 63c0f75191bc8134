"""Sources, sinks, stored results and streams."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from retailgrain import sources
from retailgrain.session import shared_dir
from retailgrain.sources.readers import JdbcSource, file_fingerprints
from retailgrain.sources.snapshots import invalidate_after, is_stale
from retailgrain.streaming import intake_stock_files, weekly_counts, weekly_counts_stream


def drop(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def test_two_stock_files(spark, tmp_path):
    drop(tmp_path / "in", "a.csv", " barcode ,quantity\n1,5\n2,\n")
    drop(tmp_path / "in", "b.csv", " barcode ,quantity\n2,3\n")
    drop(tmp_path / "in", "c.txt", "not,this\n9,9\n")
    run = dt.datetime(2024, 5, 1, 12)
    rows = sources.read_stock_files(spark, str(tmp_path / "in"), run_ts=run, hash_rows=True)
    got = rows.orderBy("source_file", "barcode").collect()
    assert [(r.barcode, r.quantity, r.source_file, r.run_ts) for r in got] == [
        ("1", "5", "a.csv", run), ("2", None, "a.csv", run), ("2", "3", "b.csv", run),
    ]
    assert len({r.content_hash for r in got}) == 3
    prints = {r.source_file: r.content_hash for r in file_fingerprints(rows, ["barcode", "quantity"]).collect()}
    assert len(set(prints.values())) == 2


def test_fingerprint_ignores_row_order(spark):
    a = spark.createDataFrame([("f", "1", None), ("f", "2", "x")], "source_file string, a string, b string")
    b = spark.createDataFrame([("f", "2", "x"), ("f", "1", None)], a.schema)
    c = spark.createDataFrame([("f", "2", "x"), ("f", None, "1")], a.schema)
    one, two, three = (file_fingerprints(d, ["a", "b"]).first().content_hash for d in (a, b, c))
    assert one == two != three


def test_headerless_crlf(spark, tmp_path):
    (tmp_path / "channels").write_bytes(b"(Other),25\r\nPaid Search,43\r\n")
    rows = sources.read_channel_sessions(spark, str(tmp_path / "channels")).collect()
    assert sorted(map(tuple, rows)) == [("(Other)", 25), ("Paid Search", 43)]


def test_jdbc_options():
    source = JdbcSource("jdbc:x", "orders", "id", "1", "1000", 8, {"user": "u"})
    options = source.options()
    assert options["numPartitions"] == "8" and options["partitionColumn"] == "id" and options["user"] == "u"
    assert options["pushDownPredicate"] == "true"


def test_stock_files_are_read_by_name(spark, tmp_path):
    drop(tmp_path / "in", "a.csv", "barcode,quantity\n1,5\n")
    drop(tmp_path / "in", "b.csv", "quantity, barcode ,brand\r\n7,2,x\r\n")
    drop(tmp_path / "in", "c.csv", '"brand","barcode"\n"y, z","3"\n')
    rows = sources.read_stock_files(spark, str(tmp_path / "in"), hash_files=True)
    got = sorted((r.barcode, r.quantity, r.brand, r.source_file) for r in rows.collect())
    assert got == [("1", "5", None, "a.csv"), ("2", "7", "x", "b.csv"), ("3", None, "y, z", "c.csv")]
    assert len({r.file_hash for r in rows.collect()}) == 3
    typed = sources.read_stock_files(spark, str(tmp_path / "in"), sources.STOCK_SCHEMA)
    assert sorted((r.barcode, r.quantity) for r in typed.collect()) == [("1", 5.0), ("2", 7.0), ("3", None)]


def test_quoted_headers_do_not_shift_columns(spark, tmp_path):
    folder = tmp_path / "in put [1]"
    drop(folder, "a.csv", 'barcode,"name, long",quantity\n1,"x, y",5\n')
    drop(folder, "b {2}.csv", '\n"quan""tity" , barcode,"say \\"hi\\""\n6,2,z\n')
    drop(folder, "c.csv", "")
    drop(folder, "d.csv", "\ufeffquantity,barcode,barcode\n7,3,4\n")
    rows = sources.read_stock_files(spark, str(folder).replace("[", "\\[").replace("]", "\\]"))
    assert {"barcode", "name, long", "quantity", 'say "hi"'} <= set(rows.columns)
    got = sorted((r.barcode, r["name, long"], r.quantity, r['say "hi"']) for r in rows.collect())
    assert got == [("1", "x, y", "5", None), ("2", None, None, "z"), ("3", None, "7", None)]


def test_each_stock_file_is_scanned_once(spark, tmp_path):
    for i in range(6):
        drop(tmp_path / "in", f"{i}.csv", ("barcode,quantity\n" if i % 2 else "quantity,barcode\n") + "1,2\n" * 500)
    rows = sources.read_stock_files(spark, str(tmp_path / "in"), sources.STOCK_SCHEMA)
    rows.collect()
    files = [len(f.split(",")) for f in __import__("re").findall(r"paths\)\[(.*?)\]", rows._jdf.queryExecution().executedPlan().toString())]
    assert rows.count() == 3000 and len(rows.inputFiles()) == 6
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 2, files


def test_heads_are_read_and_no_more(spark, tmp_path):
    """A task stops after the first line: of a file of 20 MB it reads a small part."""
    from retailgrain.sources.readers import stock_layouts

    drop(tmp_path / "in", "big.csv", "barcode,quantity\n" + "1234567890,12\n" * 1_500_000)
    drop(tmp_path / "in", "small.csv", "quantity,barcode\n1,2\n")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    bytes_before = read_bytes(spark)
    layouts = stock_layouts(spark, str(tmp_path / "in"))
    assert {layout.names for layout in layouts} == {("barcode", "quantity"), ("quantity", "barcode")}
    assert read_bytes(spark) - bytes_before < 2_000_000
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def read_bytes(spark) -> int:
    """Bytes that Hadoop's local file system has read in this process."""
    total = 0
    for stats in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics():
        total += stats.getBytesRead()
    return total


def test_recon_export_without_rows(spark, tmp_path):
    path = str(tmp_path / "out")
    sources.write_recon_export(spark.range(0), path, "nothing")
    assert [tuple(r) for r in spark.read.option("header", True).csv(path).collect()] == [("nothing",)]


def test_csv_has_no_personal_columns(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.createDataFrame([(1, "a@b", "x")], "id int, email string, product string")
    sources.write_csv(rows, path, drop=sources.PERSONAL_COLUMNS)
    assert spark.read.option("header", True).csv(path).columns == ["id", "product"]


def test_table_round(spark):
    schema = T.StructType.fromDDL("a bigint, b string")
    sources.create_table(spark, "rg_round", schema, shared_dir(spark, "round"))
    sources.append_rows(spark.createDataFrame([("x", 1), (None, 2)], "b string, a int"), "rg_round")
    sources.create_table(spark, "rg_round", schema, shared_dir(spark, "round"))
    assert spark.table("rg_round").count() == 2
    sources.delete_not_null(spark, "rg_round", "b", shared_dir(spark, "round"))
    assert [tuple(r) for r in spark.table("rg_round").collect()] == [(2, None)]
    sources.replace_rows(spark.createDataFrame([(7, "y")], "a int, b string"), "rg_round")
    assert [tuple(r) for r in spark.table("rg_round").collect()] == [(7, "y")]
    spark.sql("DROP TABLE rg_round")


@pytest.mark.parametrize("parts", [(), ("p",)])
def test_a_failure_before_the_switch_leaves_the_old_rows(spark, parts, monkeypatch):
    from retailgrain.sources import sinks

    spark.sql("DROP TABLE IF EXISTS rg_switch")
    rows = spark.createDataFrame([(1, "x", 1), (2, None, 1), (3, "y", 2), (4, None, 3)], "a bigint, b string, p int")
    sources.create_table(spark, "rg_switch", rows.schema, shared_dir(spark, "switch"), parts)
    sources.append_rows(rows, "rg_switch")
    old = sorted(map(tuple, spark.table("rg_switch").collect()))
    reader = spark.table("rg_switch")

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(sinks, "_switch", fail)
        for change in (lambda: sources.delete_not_null(spark, "rg_switch", "b", shared_dir(spark, "rest")), lambda: sources.replace_rows(rows.limit(1), "rg_switch")):
            with pytest.raises(RuntimeError):
                change()
            assert sorted(map(tuple, spark.table("rg_switch").collect())) == old
    sources.delete_not_null(spark, "rg_switch", "b", shared_dir(spark, "rest"))
    assert sorted(map(tuple, spark.table("rg_switch").collect())) == [(2, None, 1), (4, None, 3)]
    assert sorted(map(tuple, reader.collect())) == old  # who began before the switch ends with the old rows
    sources.append_rows(rows.where("a = 3"), "rg_switch")
    sources.replace_rows(spark.createDataFrame([(9, "z", 7)], rows.schema), "rg_switch")
    assert [tuple(r) for r in spark.table("rg_switch").collect()] == [(9, "z", 7)]
    spark.sql("DROP TABLE rg_switch")


def test_tables_with_listed_partitions_are_not_switched(spark):
    spark.sql("DROP TABLE IF EXISTS rg_listed")
    spark.sql(f"CREATE TABLE rg_listed (a bigint, p int) USING parquet PARTITIONED BY (p) LOCATION '{shared_dir(spark, 'listed')}'")
    with pytest.raises(ValueError):
        sources.publish_version(spark.createDataFrame([(1, 1)], "a bigint, p int"), "rg_listed")
    spark.sql("DROP TABLE rg_listed")


def test_partitioned_table_round(spark):
    spark.sql("DROP TABLE IF EXISTS rg_parts")
    location = shared_dir(spark, "parts")
    spark.sql(f"CREATE TABLE rg_parts (a bigint, b string, p int) USING parquet PARTITIONED BY (p) LOCATION '{location}'")
    rows = spark.createDataFrame([(1, "x", 1), (2, None, 1), (3, "y", 2), (4, None, 3)], "a bigint, b string, p int")
    sources.append_rows(rows, "rg_parts")
    sources.delete_not_null(spark, "rg_parts", "b", shared_dir(spark, "rest"))
    assert sorted(map(tuple, spark.table("rg_parts").collect())) == [(2, None, 1), (4, None, 3)]
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    sources.replace_rows(spark.createDataFrame([(7, "z", 3)], "a bigint, b string, p int"), "rg_parts")
    assert [tuple(r) for r in spark.table("rg_parts").collect()] == [(7, "z", 3)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    spark.sql("DROP TABLE rg_parts")


def test_amounts_are_rounded_after_the_sum(spark):
    from retailgrain.operators.aggregates import money_sum

    amounts = spark.range(1000).select(F.lit(0.004).alias("v"))
    assert amounts.agg(money_sum(F.col("v"))).first()[0] == 4.0


def test_exact_sums_of_large_small_and_negative_amounts(spark):
    from decimal import Decimal

    from retailgrain.functions import exact_sum

    values = [0.1] * 10 + [1e15, -1e15, 123456789.25, -0.000001, -2.675, 4503599627370497.0, 1e18, None, 0.0000005, -0.0000005]
    got = spark.createDataFrame([(v,) for v in values], "v double").agg(exact_sum(F.col("v"))).first()[0]
    rounded = lambda v: Decimal(repr(v)).quantize(Decimal("0.000001"), "ROUND_HALF_UP")
    assert got == sum(rounded(v) for v in values if v is not None)
    decimals = spark.createDataFrame([(Decimal("12345678901234567.89"),), (Decimal("0.01"),)], "v decimal(20,2)")
    assert decimals.agg(exact_sum(F.col("v"))).first()[0] == Decimal("12345678901234567.90")
    assert spark.range(3).agg(exact_sum(F.when(F.col("id") > 9, 1.0))).first()[0] is None
    assert spark.range(4).agg(exact_sum(F.col("id"))).first()[0] == 6


@pytest.mark.parametrize("odd", [1e23, float("nan"), float("inf"), -1e19])
def test_amounts_that_do_not_fit_are_refused(spark, odd):
    from pyspark.errors import PySparkException

    from retailgrain.functions import amount_parts, exact_sum
    from retailgrain.plans import fact_sums

    amounts = spark.createDataFrame([(1.5,), (odd,), (None,), (2.25,)], "v double")
    assert tuple(amounts.agg(*[p.alias(f"p{i}") for i, p in enumerate(amount_parts(F.col("v")))]).first()) == (3, 750_000, 1)
    with pytest.raises(PySparkException, match="1 amounts are not finite"):
        amounts.agg(exact_sum(F.col("v"))).collect()
    facts = spark.createDataFrame([(None, 6, "r", "A", "c", "s", *[odd] * 9)], sources.readers.SALES_FACT_SCHEMA)
    with pytest.raises(PySparkException, match="not finite"):
        fact_sums(facts.withColumn("year0_checkout", F.lit(1.0)).withColumn("year0_minus_1_checkout", F.lit(1.0)).withColumn("year0_minus_2_checkout", F.lit(1.0))).collect()


def test_map_of_many_keys_plans_no_job(spark):
    from retailgrain.operators.reshape import keyed_map

    many = spark.range(10_001).withColumn("n", F.col("id") * 2)
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    mapped = keyed_map(many, "id", ["n"])
    assert len(tracker.getJobIdsForGroup(None)) == before
    assert len(mapped.first()["n"]) == 10_001


def test_staleness():
    day = dt.date(2024, 5, 6)
    assert is_stale(None, day, None)
    assert not is_stale(day, day, 1) and is_stale(day, day + dt.timedelta(1), 1)
    assert not is_stale(day, day + dt.timedelta(999), None)
    assert invalidate_after(day, day) and not invalidate_after(day, day - dt.timedelta(1))
    assert invalidate_after(None, day) and not invalidate_after(day, None)


def test_stored_result(spark):
    path = shared_dir(spark, "stored")
    calls = []

    def build():
        calls.append(1)
        return spark.range(len(calls)).select("id")

    day = dt.date(2024, 5, 6)
    count = lambda **kw: sources.snapshot_if_stale(spark, path, kw.pop("as_of", day), build, **kw).count()
    assert count() == 1 and count() == 1 and len(calls) == 1
    assert count(force=True) == 2
    assert count(as_of=day + dt.timedelta(3), ttl_days=7) == 2
    assert count(as_of=day + dt.timedelta(7), ttl_days=7) == 3
    assert count(as_of=day + dt.timedelta(99), ttl_days=None) == 3 and len(calls) == 3


def test_intake_takes_each_file_once(spark, tmp_path):
    folder = tmp_path / "drop"
    stored, checkpoint = shared_dir(spark, "stock"), shared_dir(spark, "ckpt")
    drop(folder, "a.csv", "barcode,quantity\n1,5\n")
    drop(folder, "skip.txt", "barcode,quantity\n9,9\n")
    assert intake_stock_files(spark, str(folder), stored, checkpoint).count() == 1
    assert intake_stock_files(spark, str(folder), stored, checkpoint).count() == 1
    drop(folder, "b.csv", "barcode,quantity\n2,1.5\n3,\n")
    rows = intake_stock_files(spark, str(folder), stored, checkpoint).orderBy("barcode").collect()
    assert [(r.barcode, r.quantity, r.source_file) for r in rows] == [
        ("1", 5.0, "a.csv"), ("2", 1.5, "b.csv"), ("3", None, "b.csv"),
    ]


def test_stream_equals_batch_over_several_runs(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    folder = str(tmp_path / "events")
    out, checkpoint = shared_dir(spark, "weekly"), shared_dir(spark, "ckpt")
    ordered = [F.col("ts") < dt.datetime(2024, 1, 17, 5), F.col("ts") >= dt.datetime(2024, 1, 17, 5)]
    for part in reversed(ordered):  # the older rows come late
        events.where(part).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(events.schema).parquet(folder)
        streamed = weekly_counts_stream(spark, stream, "ts", ["event_type"], "value", out, checkpoint)
    batch = weekly_counts(events, "ts", ["event_type"], "value")
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_shared_dir_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first.startswith(base) and first != second


def test_unknown_rule_ops_are_refused():
    from retailgrain.functions import metric_condition
    from retailgrain.rules import MetricRule

    with pytest.raises(ValueError):
        metric_condition(MetricRule("m", "f", "like", ("x",)))

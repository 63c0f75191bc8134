"""Sources and sinks: the given tables written out through the sinks and read back through the sources."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F, types as T

from retailgrain import sources
from retailgrain.checks import standins as s
from retailgrain.checks.aggregates import CUBE_TABLE_SQL, RECON_SQL, recon
from retailgrain.checks.registry import check
from retailgrain.functions.dates import report_window
from retailgrain.plans.order_cube import order_cube, to_cube_table
from retailgrain.plans.yoy_sales import fact_sums
from retailgrain.rules.fixed_values import QUANTITY_BUCKETS, metric_rules, price_buckets
from retailgrain.rules.tables import rule_table
from retailgrain.session import shared_dir
from retailgrain.sources.sinks import cube_schema

DAY, DAY_BEFORE = dt.date(2001, 7, 30), dt.date(2001, 7, 29)


@check("src_orders", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderdate >= DATE '2001-05-21' AND o_orderdate < DATE '2001-07-30'""")
def src_orders(spark, sf):
    start, end = report_window(s.AS_OF)
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    return sources.read_orders(spark, f"{sf}/orders.parquet", "o_orderdate", start, end, columns)


@check("src_sales_fact", f"WITH {s.FACT_SQL} SELECT * FROM fact")
def src_sales_fact(spark, sf):
    path = shared_dir(spark, "sales-facts")
    s.facts(spark, sf).write.parquet(path)
    return fact_sums(sources.read_sales_facts(spark, path)).withColumn("month", F.col("month").cast("bigint"))


@check("src_snapshot", f"WITH {s.STOCK_SQL} SELECT barcode, quantity, name FROM own_stock")
def src_snapshot(spark, sf):
    path = shared_dir(spark, "snapshot")
    stock = s.own_stock(spark, sf)
    for day, scale in ((DAY_BEFORE, 10), (DAY, 1)):
        rows = stock.withColumns({"quantity": F.col("quantity") * scale, "snapshot_date": F.lit(day)})
        rows.write.mode("append").partitionBy("snapshot_date").parquet(path)
    return sources.read_snapshot(spark, path, DAY, ["barcode", "quantity", "name"], "snapshot_date")


def _stock_folder(spark, sf) -> str:
    folder = shared_dir(spark, "stock-files")
    stock = s.supplier_stock(spark, sf)
    odd = F.crc32(F.coalesce(F.col("barcode").cast("string"), F.lit(""))) % 2 == 1
    # Two layouts in one folder: padded headers, and other columns first.
    for part, columns in ((stock.where(odd).toDF(" barcode", "quantity ", " brand "), None), (stock.where(~odd), ("brand", "quantity", "barcode"))):
        (part if columns is None else part.select(*columns)).write.mode("append").option("header", True).csv(folder)
    return folder


_STOCK_ROWS_SQL = f"WITH {s.STOCK_SQL} SELECT barcode, quantity, brand FROM supplier_stock"


@check("src_stock_files", _STOCK_ROWS_SQL)
def src_stock_files(spark, sf):
    rows = sources.read_stock_files(spark, _stock_folder(spark, sf))
    return rows.select("barcode", F.col("quantity").cast("double").alias("quantity"), "brand")


@check("src_headerless_csv", """
SELECT event_type || '/' || CAST(user_id AS VARCHAR) AS channel, count(*) AS sessions FROM events GROUP BY 1""")
def src_headerless_csv(spark, sf):
    path = shared_dir(spark, "channels")
    label = F.concat("event_type", F.lit("/"), F.col("user_id").cast("string"))
    counts = s.table(spark, sf, "events").groupBy(label.alias("channel")).agg(F.count(F.lit(1)).alias("sessions"))
    line = F.concat_ws(",", "channel", F.col("sessions").cast("string"))
    counts.select(line.alias("value")).write.option("lineSep", "\r\n").text(path)
    return sources.read_channel_sessions(spark, path)


@check("src_rules", f"""
WITH {s.HEADERS_SQL},
rules(metric, v) AS (VALUES ('Atšauktų', 'canceled'), ('Eksportuoti', 'ORDEFOLDER_PREPARING'), ('Paruošta atsiėmimui', 'holded'),
  ('Paruošta atsiėmimui', 'ORDEFOLDER_READYTOTAKE'), ('Nauji', 'processing'), ('Laukia apmokėjimo', 'wait_payment'),
  ('Užbaigti', 'complete'), ('Užbaigti', 'ORDEFOLDER_COMPLETE'))
SELECT metric, v AS status, count(*) AS orders FROM headers JOIN rules ON order_status = v GROUP BY 1, 2""")
def src_rules(spark, sf):
    rules = rule_table(spark, metric_rules()).where(F.col("field") == "order_status")
    values = rules.select("metric", F.explode("values").alias("status"))
    joined = s.headers(spark, sf).join(values, F.col("order_status") == F.col("status"))
    return joined.groupBy("metric", "status").agg(F.count(F.lit(1)).alias("orders"))


def _new_table(spark, schema: T.StructType, name: str, partitioned_by: tuple[str, ...] = ()) -> str:
    """One name for each query, so that runs do not pile up tables."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    sources.create_table(spark, name, schema, shared_dir(spark, "table"), partitioned_by)
    return name


def _cube(spark, sf):
    return to_cube_table(order_cube(s.lines(spark, sf), s.CITY_RULES, price_buckets(), QUANTITY_BUCKETS, s.OTHER_CITY))


@check("sink_create_table", "SELECT p_partkey, p_name, p_size FROM part")
def sink_create_table(spark, sf):
    part = s.table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    location = shared_dir(spark, "table")
    name = "rg_sink_create_table"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    sources.create_table(spark, name, part.schema, location)
    sources.append_rows(part, name)
    sources.create_table(spark, name, part.schema, location)  # exists: nothing happens
    return spark.table(name)


@check("sink_append", """
SELECT s_suppkey AS id, s_name AS name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer""")
def sink_append(spark, sf):
    name = _new_table(spark, T.StructType.fromDDL("id bigint, name string"), "rg_sink_append")
    supplier, customer = s.table(spark, sf, "supplier"), s.table(spark, sf, "customer")
    sources.append_rows(supplier.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")), name)
    sources.append_rows(customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), name)
    return spark.table(name)


@check("sink_delete_matching", "SELECT o_orderkey, NULL::VARCHAR AS status FROM orders WHERE o_orderstatus = 'P'")
def sink_delete_matching(spark, sf):
    orders = s.table(spark, sf, "orders")
    rows = orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    name = _new_table(spark, rows.schema, "rg_sink_delete_matching")
    sources.append_rows(rows, name)
    sources.delete_not_null(spark, name, "status", shared_dir(spark, "table"))
    return spark.table(name)


@check("sink_delete_partitioned", """
SELECT o_orderkey, NULL::VARCHAR AS status, o_orderpriority AS priority FROM orders WHERE o_orderstatus = 'P'""")
def sink_delete_partitioned(spark, sf):
    """A partitioned table is switched to its new folder in one step, too."""
    orders = s.table(spark, sf, "orders")
    rows = orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), F.col("o_orderpriority").alias("priority"))
    name = _new_table(spark, rows.schema, "rg_sink_delete_partitioned", ("priority",))
    sources.append_rows(rows, name)
    sources.delete_not_null(spark, name, "status", shared_dir(spark, "table"))
    return spark.table(name)


@check("sink_replace_partitioned", "SELECT o_orderkey, o_custkey, o_orderpriority AS priority FROM orders WHERE o_orderpriority <> '1-URGENT'")
def sink_replace_partitioned(spark, sf):
    orders = s.table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("priority"))
    name = _new_table(spark, orders.schema, "rg_sink_replace_partitioned", ("priority",))
    sources.append_rows(orders, name)
    sources.replace_rows(orders.where("priority <> '1-URGENT'"), name)  # one partition less
    return spark.table(name)


@check("sink_replace", CUBE_TABLE_SQL)
def sink_replace(spark, sf):
    name = _new_table(spark, cube_schema(), "rg_sink_replace")
    empty = {f.name: F.lit(None).cast(f.dataType) for f in cube_schema()}
    part = s.table(spark, sf, "part").select(*[
        (F.col("p_name") if c == "Preke" else value).alias(c) for c, value in empty.items()
    ])
    sources.append_rows(part, name)
    sources.replace_rows(_cube(spark, sf), name)  # nothing of the first load stays
    return spark.table(name).withColumn("Apsipirkimu_kiekis", s.micro(F.col("Apsipirkimu_kiekis")))


@check("sink_csv", f"WITH {s.HEADERS_SQL} SELECT id, order_no, payment_status, country FROM headers")
def sink_csv(spark, sf):
    path = shared_dir(spark, "csv")
    rows = s.headers(spark, sf).select("id", "order_no", "payment_status", "street", "country")
    sources.write_csv(rows, path, drop=sources.PERSONAL_COLUMNS)
    return spark.read.option("header", True).schema("id bigint, order_no string, payment_status string, country string").csv(path)


@check("sink_recon_export", f"WITH {RECON_SQL} SELECT barcode, own_barcode, match_type, diff FROM recon")
def sink_recon_export(spark, sf):
    path = shared_dir(spark, "recon")
    rows = recon(spark, sf).select("barcode", "own_barcode", "match_type", "diff")
    sources.write_recon_export(rows, path)
    schema = "barcode string, own_barcode string, match_type string, diff bigint"
    return spark.read.option("header", True).schema(schema).csv(path)


@check("snapshot_if_stale", """
SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent' ELSE 'other' END AS kind, count(*) AS orders, 1 AS version
FROM orders GROUP BY 1
UNION ALL
SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent' ELSE 'other' END, count(*), 3 FROM orders GROUP BY 1""")
def snapshot_if_stale(spark, sf):
    path = shared_dir(spark, "report")
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "urgent").otherwise("other")
    counts = s.table(spark, sf, "orders").groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("orders"))

    def build(version: int):
        return lambda: counts.withColumn("version", F.lit(version))

    sources.snapshot_if_stale(spark, path, DAY, build(1))
    same_day = sources.snapshot_if_stale(spark, path, DAY, build(2))  # fresh: version 1 stays
    later = sources.snapshot_if_stale(spark, path, DAY + dt.timedelta(days=1), build(3))
    return same_day.unionByName(later)

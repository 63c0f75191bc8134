"""Structured Streaming jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from retailgrain.checks import standins as s
from retailgrain.checks.aggregates import WEEKLY_SQL
from retailgrain.checks.registry import check
from retailgrain.rules.fixed_values import metric_rules
from retailgrain.session import shared_dir
from retailgrain.streaming import OrderMetrics, fold_batches, intake_stock_files, quarantined_files, stored_counts, weekly_counts_stream


def _taken_stock(spark, sf):
    """Two drops into one folder, each in two layouts and with a file that lacks a column; the second run takes in the new files only."""
    folder, stored = shared_dir(spark, "drop"), shared_dir(spark, "stock")
    checkpoint = shared_dir(spark, "intake-checkpoint")
    for drop in (s.supplier_stock(spark, sf), s.own_stock(spark, sf)):
        odd = F.crc32(F.coalesce("barcode", F.lit(""))) % 2 == 1
        drop.where(odd).select("barcode", "quantity").write.mode("append").option("header", True).csv(folder)
        drop.where(~odd).select("quantity", F.lit("a, b").alias("note, quoted"), "barcode").write.mode("append").option("header", True).csv(folder)
        drop.groupBy().agg(F.max("barcode").alias("barcode")).coalesce(1).write.mode("append").option("header", True).csv(folder)
        taken = intake_stock_files(spark, folder, stored, checkpoint)
    return taken, stored


@check("src_file_intake", f"WITH {s.STOCK_SQL} SELECT barcode, quantity FROM supplier_stock UNION ALL SELECT barcode, quantity FROM own_stock")
def src_file_intake(spark, sf):
    return _taken_stock(spark, sf)[0].select("barcode", "quantity")


@check("src_file_quarantine", "SELECT count(*) AS files, 'barcode' AS columns, 'quantity' AS missing FROM range(2)")
def src_file_quarantine(spark, sf):
    """The files that the intake refused: one in each drop."""
    refused = quarantined_files(spark, _taken_stock(spark, sf)[1])
    named = refused.select(*[F.concat_ws(",", c).alias(c) for c in ("columns", "missing")])
    return named.groupBy("columns", "missing").agg(F.count(F.lit(1)).alias("files"))


@check("stream_weekly_orders", f"""
WITH {WEEKLY_SQL}
SELECT CAST(week_start AS VARCHAR) AS week_start, period_kind, metric, value FROM weekly""")
def stream_weekly_orders(spark, sf):
    """Headers and details in two drops that do not fit together: half of the details come before or after their header."""
    headers, details = s.headers(spark, sf), s.details(spark, sf)
    folder = {name: shared_dir(spark, name) for name in ("headers", "details", "orders", "orders-checkpoint")}
    orders = OrderMetrics(spark, folder["orders"], s.products(spark, sf), s.deliveries(spark), fold_after=2)
    for drop in range(2):
        for name, rows, key in (("headers", headers, F.col("id")), ("details", details, F.col("id") + 1)):
            rows.where(F.pmod(F.xxhash64(key), F.lit(2)) == drop).write.mode("append").parquet(folder[name])
        streams = [spark.readStream.schema(rows.schema).parquet(folder[name]) for name, rows in (("headers", headers), ("details", details))]
        orders.run(*streams, folder["orders-checkpoint"])
    metrics = orders.metrics(metric_rules(), s.SHOP_RULES)
    return metrics.select(F.col("week_start").cast("string").alias("week_start"), "period_kind", "metric", "value")


EVENT_COUNTS_SQL = """
SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week_start, event_type, count(*) AS row_count,
  CAST(sum(CAST(value AS DECIMAL(28,6))) AS DOUBLE) AS value_sum FROM events GROUP BY 1, 2"""


def _shown(counts):
    return counts.withColumns({"week_start": F.col("week_start").cast("string"), "value_sum": F.col("value_sum").cast("double")})


@check("stream_weekly_counts", EVENT_COUNTS_SQL)
def stream_weekly_counts(spark, sf):
    schema = s.table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    counts = weekly_counts_stream(
        spark, stream, "ts", ["event_type"], "value", shared_dir(spark, "weekly"), shared_dir(spark, "weekly-checkpoint")
    )
    return _shown(counts)


@check("stream_folded_counts", EVENT_COUNTS_SQL)
def stream_folded_counts(spark, sf):
    """Several batches, folded in between and read after more of them came."""
    events = s.table(spark, sf, "events")
    folder, out, checkpoint = shared_dir(spark, "events"), shared_dir(spark, "folded"), shared_dir(spark, "folded-checkpoint")
    for drop in range(3):
        events.where(F.pmod(F.xxhash64(*events.columns), F.lit(3)) == drop).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(events.schema).parquet(folder)
        weekly_counts_stream(spark, stream, "ts", ["event_type"], "value", out, checkpoint)
        if drop == 1:
            fold_batches(spark, out, ["event_type"])
    return _shown(stored_counts(spark, out, ["event_type"]))

"""Times the headline queries and prints one JSON line.

Every query is planned anew and run to the end (rows go to the noop sink) in each
round. The first round is reported as cold, the median of the others as warm.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from retailgrain import build_session  # noqa: E402
from retailgrain.checks import CHECKS  # noqa: E402

# Light queries first, so that the reports find a warm JVM.
HEADLINES = (
    "filter_date_range",
    "join_inner_equi",
    "join_first_substring",
    "join_full_outer",
    "content_fingerprint",
    "clean_text",
    "agg_group_sum_fact",
    "agg_scopes",
    "win_share_of_total",
    "agg_group_count",
    "join_rule_theta",
    "win_order_weight",
    "report_weekly_orders",
    "report_order_cube",
    "report_yoy_sales",
    "report_stock_recon",
    "sink_replace",
    "report_listed_cities",
    "report_listed_shops",
    "src_file_intake",
    "stream_weekly_counts",
    "stream_weekly_orders",
)


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    CHECKS[name].query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rounds = int(os.environ.get("BENCH_ROUNDS", "3"))
    names = sys.argv[1:] or HEADLINES
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="retailgrain-bench-"),
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="retailgrain-warehouse-"),
    }
    partitions = None if cpus == "*" else int(cpus)
    spark = build_session("retailgrain-bench", f"local[{cpus}]", partitions, conf)
    spark.sparkContext.setLogLevel("ERROR")
    cold, warm = {}, {}
    for name in names:
        times = [run(spark, name, sf_dir) for _ in range(rounds)]
        cold[name] = round(times[0], 3)
        warm[name] = round(statistics.median(times[1:] or times), 3)
    print(json.dumps({
        "metric": "headline queries, warm, sum of medians",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

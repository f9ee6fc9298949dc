"""Headline query times; prints one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores."""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession

from tallywatch import fixtures
from tallywatch.catalog.queries import QUERIES

BATCH = [
    "user_metrics", "user_metrics_lineitem", "metrics_join_form", "fraud_alerts", "distinct_counterparties",
    "pair_edges", "dedup_tx", "running_balance", "decode_json", "recent_users_view", "tx_per_second", "monitor_summary",
]
STREAM = ["stream_monitor", "stream_incremental_metrics", "stream_dedup"]
RUNS = 3


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    result: DataFrame = QUERIES[name](spark, sf_dir)
    result.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    times = {}
    for name in BATCH:
        seconds(spark, name, sf_dir)
        times[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(RUNS)), 3)
    for name in STREAM:
        times[name] = round(seconds(spark, name, sf_dir), 3)
    rows = fixtures.tx_burst(spark, sf_dir).count()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "stream_tx_per_sec": {name: round(rows / times[name]) for name in STREAM[:2]},
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the
runs per query (the median counts, after one unmeasured run).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskmart.registry import QUERIES  # noqa: E402

HEADLINE = (
    "bronze_lineage", "cdc_parse_customers", "cdc_quality_payments", "cdc_latest_per_key",
    "cdc_current_state", "cdc_quarantine", "payment_decisions", "reason_counts",
    "daily_business_kpis", "daily_fraud_kpis", "seller_performance", "customer_360",
    "seller_watchlist", "dim_customers", "dim_products", "dim_geolocation_zip", "fact_orders",
    "fact_payments", "fact_reviews", "daily_commerce_kpis", "delivery_performance",
    "market_seller_performance", "market_customer_360", "payment_risk_signals",
    "risk_band_summary", "top_risky_payments", "replay_customers", "replay_listings",
    "replay_orders", "replay_order_items", "replay_payments", "basket_match",
    "insert_absent_orders", "upsert_customers", "gates_summary",
)


def seconds(run, spark, sf_dir) -> float:
    start = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("riskmart-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in chosen:
        seconds(QUERIES[name], spark, sf_dir)
        times[name] = round(
            statistics.median(seconds(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3
        )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "riskmart_headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

"""Time the headline queries on ``$BENCH_SF_DIR`` and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parcella.plans.registry import QUERIES  # noqa: E402

HEADLINE = (
    "sale_lines",
    "dedup_sales",
    "clip_sales",
    "commune_agg",
    "dept_agg",
    "vintage_prices",
    "single_dwelling_price_approx",
    "facility_counts",
    "latest_period_rates",
    "nearest_station",
    "nearest_metropolis",
    "stops_per_cell",
    "zone_prices",
    "territory_score",
    "price_histogram",
    "national_weighted_median",
    "points_sample",
    "review_segments",
    "segment_themes",
    "wordcloud",
    "verbatims",
    "calibration",
    "profile_table",
    "validate_rules",
    "choropleth_commune",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("parcella-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["facility_counts"](spark, sf_dir).count()  # start the engine
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

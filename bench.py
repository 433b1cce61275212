"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores and
BENCH_QUERIES (comma-separated, or ``all``) the queries to time.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalogue.queries import QUERIES  # noqa: E402

HEADLINE = (
    "arrests_by_month",
    "arrests_by_hour",
    "monthly_violent",
    "yearly_violent",
    "summary_report",
    "summary_report_events",
    "hotspots_top10",
    "unit_year_matrix",
    "pair_correlation",
    "pair_correlation_full",
    "hierarchy_counts",
    "era_means",
    "paired_t",
    "csv_roundtrip",
    "clean_text_fields",
    "weekly_panel",
    "panel_dense",
    "panel_split",
    "features_full",
    "features_base",
    "persistence_metrics",
    "fairness_by_band",
    "disparity",
    "error_quartiles",
    "calibrated_errors",
    "gbt_forecast",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = {"": HEADLINE, "all": tuple(QUERIES)}.get(chosen) or tuple(chosen.split(","))

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("blotter-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()

    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()

    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

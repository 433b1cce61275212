"""Run one analysis with spark-submit.

    spark-submit --py-files blotter.zip analyse.py prepare  raw.csv  incidents/
    spark-submit --py-files blotter.zip analyse.py temporal incidents/ results/

``prepare`` reads the raw CSV and writes the typed table, partitioned by year,
and malformed rows beside it, in a folder whose name ends in ``_rejected``.
The other analyses read that table, or the CSV if its name ends in ``.csv``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from blotter.plans.arrest_patterns import arrest_patterns
from blotter.plans.fairness_audit import fairness_audit
from blotter.plans.forecasting import forecast_next_week
from blotter.plans.geography import geography
from blotter.plans.prepare import prepare
from blotter.plans.temporal import temporal_report
from blotter.roles import Roles
from blotter.runtime import scratch_scope
from blotter.sources.incidents import normalise, read_incidents_csv

ANALYSES = {
    "arrests": arrest_patterns,
    "temporal": temporal_report,
    "geography": geography,
    "forecast": forecast_next_week,
    "fairness": fairness_audit,
}


def load(spark: SparkSession, path: str) -> tuple[DataFrame, Roles]:
    if path.endswith(".csv"):
        return normalise(read_incidents_csv(spark, path)), Roles()
    table = spark.read.parquet(path)
    return table, Roles(year_part="year" if "year" in table.columns else None)


def main() -> None:
    parser = argparse.ArgumentParser(description="Incident analytics on Spark")
    parser.add_argument("analysis", choices=["prepare", *ANALYSES])
    parser.add_argument("input", help="raw CSV or typed parquet table")
    parser.add_argument("output", help="folder for the results")
    parser.add_argument("--mixed", action="store_true", help="prepare: the files' headers differ")
    args = parser.parse_args()

    spark = (
        SparkSession.builder.appName(f"incidents-{args.analysis}")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    if args.analysis == "prepare":
        counts = prepare(spark, args.input, args.output, f"{args.output.rstrip('/')}_rejected", mixed=args.mixed)
        print(counts)
    else:
        incidents, roles = load(spark, args.input)
        with scratch_scope(spark):
            for name, result in ANALYSES[args.analysis](incidents, args.output, roles=roles).items():
                print(name)
                result.show(20, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()

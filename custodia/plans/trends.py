"""County trends: read, summarise, write.

    python -m custodia.plans.trends --county FILE --out DIR [--all]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from custodia.operators import trends
from custodia.sources import landing, sinks


def main() -> None:
    parser = argparse.ArgumentParser(description="County trends to Parquet, with a summary")
    parser.add_argument("--county", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--all", action="store_true", help="every county, not only the target ones")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("custodia-trends").getOrCreate()
    counties = landing.read_county_trends(spark, args.county)
    trends.profile(counties).show()
    trends.latest_year_summary(counties).show(truncate=False)
    sinks.write_trends(trends.target_counties(counties, keep_all=args.all), args.out)


if __name__ == "__main__":
    main()

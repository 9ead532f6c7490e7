"""``spark-submit`` entry: features from JSON files, or one day of the raw table."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from cardvigil.plans.daily import run_features, run_features_on_json


def main() -> None:
    # The option names.
    parser = argparse.ArgumentParser(prog="cardvigil")
    parser.add_argument("--input", required=True, help="JSON files, or the raw table with --run-date")
    parser.add_argument("--output", required=True, help="folder of the feature files")
    parser.add_argument("--run-date", type=date.fromisoformat, help="YYYY-MM-DD")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("cardvigil-features").getOrCreate()
    if args.run_date:
        run_features(spark, args.input, args.output, args.run_date)
    else:
        run_features_on_json(spark, args.input, args.output)
    spark.stop()


if __name__ == "__main__":
    main()

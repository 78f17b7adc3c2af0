"""``spark-submit`` entry: RATINGS PAIRS OUTPUT [--sides FOLDER] [--preset NAME]."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from starblend.plans.presets import PRESETS
from starblend.plans.recommender import run_job


def main() -> None:
    args = argparse.ArgumentParser(prog="starblend")
    args.add_argument("ratings")
    args.add_argument("pairs")
    args.add_argument("output")
    args.add_argument("--sides")
    args.add_argument("--preset", choices=sorted(PRESETS), default="stable")
    given = args.parse_args()
    spark = SparkSession.builder.appName("starblend").getOrCreate()
    model, predicted = run_job(
        spark, given.ratings, given.pairs, given.output, given.sides, given.preset
    )
    if predicted.where("truth IS NOT NULL").isEmpty():
        reports = {"weights": model.weight_rows(spark), "profile": model.profile(predicted)}
    else:
        reports = model.evaluate(predicted)
    for name, report in reports.items():
        print(name)
        report.show(report.count(), truncate=False)
    model.work.close()
    spark.stop()


if __name__ == "__main__":
    main()

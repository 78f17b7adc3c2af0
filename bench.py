"""Time the headline queries on one machine and print one JSON line.

``BENCH_SF_DIR`` names the tables and ``BENCH_CPUS`` the cores.  The pipeline runs with every value of the preset
``BENCH_PRESET`` (aggressive unless named); ``BENCH_FULL=0`` leaves it out.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from starblend.plans import tables  # noqa: E402
from starblend.plans.catalog import QUERIES, models  # noqa: E402

HEADLINE = [
    "dedupe_ratings",
    "ratings_profile",
    "bias_predict",
    "item_similarities",
    "item_similarities_sparse",
    "cf_predict",
    "cf_predict_sparse",
    "assemble_features",
    "user_features",
    "business_features",
    "latent_predict",
    "boosted_stumps",
    "blend_fitted",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("starblend-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "20g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def full(spark, folder: str, preset: str) -> dict[str, float]:
    """One run with the whole preset; seconds to fit, seconds to score and write nothing."""
    ratings = tables.rating_rows(spark, folder)
    start = time.time()
    model = models.hybrid_model(spark, folder, preset)
    fitted = time.time()
    run(model.transform(tables.test_rows(ratings)))
    done = time.time()
    model.work.close()
    return {f"hybrid_{preset}_fit": fitted - start, f"hybrid_{preset}_score": done - fitted}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    run(QUERIES["global_mean"](spark, folder))  # start the session outside the timings
    seconds = {}
    for name in HEADLINE:
        start = time.time()
        run(QUERIES[name](spark, folder))
        seconds[name] = time.time() - start
    if os.environ.get("BENCH_FULL", "1") == "1":
        seconds |= full(spark, folder, os.environ.get("BENCH_PRESET", "aggressive"))
    seconds = {name: round(s, 3) for name, s in seconds.items()}
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

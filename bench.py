"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import ANON, QUERIES, flagship, ws_of  # noqa: E402
from chatloom.operators import render  # noqa: E402
from chatloom.plans.session import prepare  # noqa: E402

HEADLINE = [
    "validation_report",
    "unique_slugs",
    "memberships",
    "thread_roots",
    "post_records",
    "anonymize_text",
    "payload_parts",
    "dedupe_import",
    "rate_by_label",
    "sustained_alert",
]


def masked_records(spark: SparkSession, folder: str):
    return render.json_lines(render.all_records(ws_of(spark, folder), ANON))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("chatloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    runs = {"all_records": flagship, "all_records_masked": masked_records}
    runs |= {name: QUERIES[name] for name in HEADLINE}
    # One small pass loads classes and compiles; it is not timed.
    flagship(spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name, run in runs.items():
        start = time.perf_counter()
        run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    posts = spark.read.parquet(f"{folder}/orders.parquet").count()
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else folder,
                "posts": posts,
                "posts_per_second": round(posts / seconds["all_records"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

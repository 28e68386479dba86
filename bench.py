"""Times headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the cores.
Every query is run twice and its second time counts, so that compilation is not measured. The two
file jobs run on fresh output folders; the raw files they read are written beforehand.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from litro.plans.bronze_to_silver import bronze_to_silver  # noqa: E402
from litro.plans.silver_to_gold import silver_to_gold  # noqa: E402
from litro.session import build_session, work_folder  # noqa: E402
from litro.workload import folders  # noqa: E402
from litro.workload.queries import QUERIES  # noqa: E402

HEADLINES = (
    "gold_monthly_prices",
    "silver_transform",
    "exact_dedup",
    "enrich_municipality",
    "unmatched_municipalities",
    "text_fold",
    "silver_quality_report",
    "check_allowed_values",
    "key_collisions",
    "profile_null_counts",
    "partition_profile",
    "bronze_profile",
    "csv_scan",
    "zip_landing",
    "gold_sorted",
    "overview_by_product",
    "q1_region_product",
    "q1_region_year",
    "q1_pivot",
    "q4_dispersion",
    "q5_ratio",
    "q5_by_state",
)


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench", cpus=int(os.environ.get("BENCH_CPUS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    folders.observations(spark, sf_dir)
    folders.direct_gold(spark, sf_dir)
    bronze, dimension = folders.bronze(spark, sf_dir), folders.dimension(spark, sf_dir)

    times = {}
    for key in HEADLINES:
        for _ in range(2):
            times[key] = seconds(
                lambda: QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            )
    for _ in range(2):
        silver, gold = work_folder(spark, "bench-silver"), work_folder(spark, "bench-gold")
        times["job_bronze_to_silver"] = seconds(lambda: bronze_to_silver(spark, bronze, silver))
        times["job_silver_to_gold"] = seconds(
            lambda: silver_to_gold(spark, silver, dimension, gold)
        )
    total = round(sum(times.values()), 3)
    scale = Path(sf_dir).name.removeprefix("sf")
    line = {"metric": "total_seconds", "value": total, "unit": "sec", "queries": times, "sf": scale}
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()

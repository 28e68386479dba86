"""The whole chain as one job; see the README for its arguments.

With `--archives`, ZIP files are landed into Bronze first. Partitions that have output are skipped.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from litro.plans.bronze_to_silver import bronze_to_silver  # noqa: E402
from litro.plans.municipalities import build_dimension  # noqa: E402
from litro.plans.silver_to_gold import check_published_gold, silver_to_gold  # noqa: E402
from litro.sources.archives import land_archives  # noqa: E402


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    for name in ("bronze", "silver", "gold", "municipalities", "dimension"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--archives")
    paths = parser.parse_args()
    spark = SparkSession.builder.appName("fuel prices").getOrCreate()
    if paths.archives:
        manifest = land_archives(spark, paths.archives, paths.bronze)
        manifest.where("erro IS NOT NULL").show(100, truncate=False)
    print("Silver:", bronze_to_silver(spark, paths.bronze, paths.silver))
    build_dimension(spark, paths.municipalities, paths.dimension)
    print("Gold:", silver_to_gold(spark, paths.silver, paths.dimension, paths.gold))
    print("Gold rows:", check_published_gold(spark, paths.gold))


if __name__ == "__main__":
    main()

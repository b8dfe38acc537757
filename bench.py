"""Seconds per headline query over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

    python bench.py [query ...]

Every query runs over its whole tables and is written to Spark's no-op sink, so all its
columns are computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from fareloom.catalog import QUERIES
from fareloom.session import local_session

HEADLINE = [
    "scan_trips",
    "hourly_means",
    "missing_profile",
    "describe_numeric",
    "iqr_outliers",
    "speed_report",
    "tip_by_payment",
    "quality_issues",
    "neg_fare_profile",
    "corr_matrix",
    "features_v1",
    "neg_fare_flags",
    "freq_encode_fitted",
    "standardize",
    "cap_outliers",
    "sample_n",
    "stratified_folds",
    "fold_metrics",
    "validate_requests",
    "assemble_features",
    "train_linear",
    "train_gbt",
    "score_batch",
]


def main(argv: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, app="fareloom-bench", memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    seconds = {}
    for name in argv or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:])

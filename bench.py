"""Benchmark the headline queries.

Runs on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` (default 8) and prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query's result is fully computed (written to the no-op sink), not
collected. ``prepare_panel`` is the one-off typing + rule marking +
partitioned Parquet write that later queries read.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "R3_exclusion_cascade",
    "A5_reason_counts",
    "A6_key_audit",
    "A7_duplicate_keys",
    "J1_prepared_with_flag",
    "A9_numeric_profile",
    "A11_median_by_education",
    "C3_box_by_education_category",
    "M1_pearson_matrix",
    "M2_spearman_matrix",
    "A17_errors_by_education",
    "M7_kmeans_grid",
    "M17_lr_grid",
    "M19_rf_grid",
    "M24_model_comparison",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from panelkit.plans import queries as Q
    from panelkit.session import local_session

    spark = local_session(master=f"local[{cpus}]", app="panelkit-bench", shuffle_partitions=int(cpus))
    # warm the JVM (class loading, codegen caches) on a tiny read
    spark.read.parquet(f"{sf_dir}/region.parquet").count()

    times: dict[str, float] = {}
    t0 = time.time()
    Q.marked(spark, sf_dir)
    times["prepare_panel"] = round(time.time() - t0, 3)
    for name in HEADLINE:
        t0 = time.time()
        df = Q.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()

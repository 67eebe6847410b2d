"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs to completion into the no-op sink. The first run of each warms
the JVM, the second one counts.
"""

import json
import os
import sys
import time

from demandtide import build_session
from demandtide.catalog import QUERIES

HEADLINE = [
    "flagship", "latest_version", "group_sum", "lookup_inner", "dedup_keep_first", "pivot_fill", "split_ratio", "column_profile",
    "rolled_values", "lagged_features", "share_of_group", "encode_categories", "feature_master_il", "raw_master_il", "raw_master_dc",
    "lag_matrix", "target_r6m", "feature_table_il", "kpi_fa", "kpi_ytd_bias", "kpi_rollup", "kpi_table", "kpi_report",
    "seasonal_correction", "rescale_children", "split_channel", "granularity_il", "scenario_build", "job_tradeflow", "job_unified_uplift",
    "forecast_direct",
]


def run(spark, folder, name):
    spark.catalog.clearCache()  # a run must not find rows that the one before kept
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        first = run(spark, folder, name)
        times[name] = run(spark, folder, name)
        print(f"{name:24s} cold {first:7.2f} warm {times[name]:7.2f}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()

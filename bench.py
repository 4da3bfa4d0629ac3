"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) select data and cores.
Each time covers the whole query: building the plan, its counting and storing jobs, and every
result row. A query runs BENCH_RUNS times (default 3) and the best time counts, so that class
loading and JIT compilation of the first run stay out.
"""

import json
import os
import time

from clinflow.registry import QUERIES
from clinflow.session import session

HEADLINE = [
    "readmissions", "readmissions_events", "los_kpis", "lab_kpis", "reference_ranges",
    "flag_abnormal", "episode_throughput", "fact_encounters", "stg_encounters",
    "ndjson_flatten_encounter", "explode_filter_observations", "dedup_first",
    "core_kpis", "provider_comparison", "page_cards", "patient_sequence", "linked_observations",
    "key_violations",
]


def run(spark, name, sf_dir):
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = session(
        "bench", f"local[{cpus}]", spark__ui__enabled="false", spark__driver__memory="16g",
        spark__sql__shuffle__partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    times = {
        name: round(min(run(spark, name, sf_dir) for _ in range(runs)), 3) for name in names}
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the tables and the cores. Each query runs once to warm
up code generation and file caches, then once timed, every result row written to a sink
that discards it.
"""

from __future__ import annotations

import json
import os
import time

from gridcensus.plans import catalogue, contracts
from gridcensus.session import release_stored, spark_session

QUERIES = catalogue.QUERIES | contracts.QUERIES
#: Timed as well, but not part of the total, which stays comparable between rounds.
CHECKS = ("final_checks", "bridge_quality", "mask_quality", "stream_completion", "zone_contract",
          "bridge_contract", "partition_store")

HEADLINE = (
    "field_explode", "field_masked_manifest", "combine_fields", "plr_weather",
    "plr_weather_population", "hottest_zones", "population_gate", "population_accounting",
    "partition_complete_full", "partition_complete_scoped", "missing_indicators",
    "ready_partitions", "retry_eligible", "cardinality_audit", "duplicate_flags",
    "constraint_audit", "numeric_describe", "triangle_build", "area_bridge", "weather_mask",
    "nearest_cell", "cells_in_union", "zone_gate", "content_hash", "listing_scan",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = spark_session(
        "bench", f"local[{cpus}]", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE + CHECKS:
        for _ in range(2):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
            release_stored(spark)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds[q] for q in HEADLINE), 3),
                      "unit": "sec", "queries": {q: seconds[q] for q in HEADLINE},
                      "checks": {q: seconds[q] for q in CHECKS}, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()

"""Benchmark of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` the timed runs
after one warm-up run. Each run computes every row and column of the result and discards it.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from cartulary.session import builder
from cartulary.workload.queries import QUERIES

HEADLINE = (
    "harmonise_iso",
    "harmonise_fgdc",
    "unified_catalogue",
    "ingest_iso",
    "merge_contacts",
    "merge_contacts_long",
    "classify_keywords",
    "classify_by_table",
    "citation_authors",
    "doi_resolve",
    "translate_lookup",
    "translate_pending",
    "translate_records",
    "append_collisions",
    "append_shares",
    "share_grants",
    "inspect_set",
    "harvest_worklist",
    "export_json_lines",
    "dq_findings",
    "dq_summary",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name]
    spark = (
        builder("bench")
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in only or HEADLINE:
        times = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median seconds per headline query",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()

"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` is the folder of the tables, ``BENCH_CPUS`` the number of
local cores, ``BENCH_QUERIES`` an optional comma list of query names.  Each
query is computed in full ``BENCH_REPEATS`` times (default 2) and its best time
counts, as the first run also compiles code.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark.session import build_session
from workload import queries as workload
from workload.queries import QUERIES, forget_loads

HEADLINE = [
    "extract_window_orders",
    "extract_window_events",
    "extract_counts",
    "lesson_view",
    "lesson_view_window",
    "type_conformity",
    "upsert_dim_rows",
    "upsert_dim_stream",
    "upsert_fact_rows",
    "upsert_fact_events",
    "upsert_insert_update_split",
    "key_violations",
    "fk_violations_orders",
    "batch_profile",
    "round_seconds",
    "mart_star_join",
    "mart_after_upsert",
    "stage_roundtrip",
    # Two whole loads (backfill, then a later window), stored.
    "upsert_all_counts",
    # One increment of a few neighbouring orders into a loaded warehouse; loading
    # that is not timed.
    "small_increment",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def compute(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in names:
        times = []
        for _ in range(int(os.environ.get("BENCH_REPEATS", "2"))):
            forget_loads()
            loaded = workload.whole_load(spark, sf_dir) if name == "small_increment" else None
            start = time.perf_counter()
            if loaded:
                workload.small_increment(spark, sf_dir, loaded)
            else:
                compute(name)
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("/sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

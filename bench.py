"""Time the queries on one table folder and print one JSON line.

``BENCH_SF_DIR``: table folder, ``BENCH_CPUS``: cores, ``BENCH_RUNS``: timed
runs per query after one warm-up (the median counts), ``BENCH_QUERIES``:
``headline`` (default), ``all``, or names separated by commas.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerloom.queries import QUERIES  # noqa: E402
from ledgerloom.session import local_session  # noqa: E402

HEADLINE = (
    "premium_report",
    "premium_by_line",
    "keylist_join",
    "param_range_join",
    "enrich_lookup",
    "enrich_composite",
    "fallback_lookup",
    "exposure_base",
    "normalize_dates",
    "stringify",
    "align_schema",
    "nfc_text",
    "table_profile",
    "pk_check",
    "distinct_row_count",
    "dedup_rows",
    "except_rows",
    "paginate",
    "number_rows",
    "unpivot_rules",
    "pivot_rules",
    "rules_full_outer",
    "missing_rules",
    "validate_rules",
    "expression_edit",
    "upsert",
    "star_publish",
    "latest_partition",
    "scan_csv_robust",
    "ingest_claims",
    "bordereaux_load",
)


def chosen() -> list[str]:
    names = os.environ.get("BENCH_QUERIES", "headline")
    if names == "all":
        return list(QUERIES)
    return list(HEADLINE) if names == "headline" else names.split(",")


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session("bench", int(os.environ.get("BENCH_CPUS", "8")), "16g")
    seconds = {}
    for name in chosen():
        run(spark, name, folder)
        seconds[name] = round(statistics.median(run(spark, name, folder) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()

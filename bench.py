"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_REPEAT`` the runs per
query, of which the fastest counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from noticelake import build_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "report_notices_with_source",
    "report_notice_categories",
    "report_notices_per_source",
    "report_popular_categories",
    "report_sources_above_average",
    "report_collection_runs",
    "report_open_notices",
    "transform_valid",
    "transform_valid_per_batch",
    "transform_metrics",
    "flag_duplicates",
    "page_run_verdicts",
    "page_records_in_order",
    "latest_runs_per_source",
    "assign_pages",
    "upsert_notices",
    "match_notices",
    "finish_runs",
    "sighting_history",
    "resolve_category_links",
    "load_notices",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    spark = build_session(
        "noticelake-bench",
        master=f"local[{cpus}]",
        extra={
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        best = None
        for _ in range(repeat):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            elapsed = time.perf_counter() - started
            best = elapsed if best is None else min(best, elapsed)
        times[name] = round(best, 3)
        print(f"{best:8.2f}s {name}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   folder of the parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names, or "all" (default: the headline queries)
"""

import json
import os
import sys
import time

from docfleet.plans.runtime import build_session
from docfleet.queries import load_all

HEADLINE = [
    "duplicate_keeper",
    "action_plan",
    "scan_report",
    "near_duplicates",
    "similar_names",
    "paginate_nonblank",
    "assemble_pages",
    "select_pages",
    "merge_documents",
    "classify_markdown",
    "render_html",
    "page_quality",
    "explode_features",
    "csv_lines",
    "convert_batch",
    "resolve_files",
    "apply_test_results",
    "batch_summary",
    "batch_progress",
    "task_status",
    "feature_progress",
    "next_feature",
    "state_as_of",
    "content_versions",
    "append_history",
    "current_status",
    "phase_history",
    "context_hash",
    "stream_task_status",
    "dedupe_redelivery",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    known = load_all()
    names = list(known) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINE
    spark = build_session("bench", cpus, **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    # the first query of a session pays for starting it
    known["batch_summary"].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        known[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

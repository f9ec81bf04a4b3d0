"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) and ``BENCH_CPUS`` (default 8) choose the data and the cores. Every
query is run to completion once, into a sink that discards the rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

from gleaner.session import get_session

HEADLINE = [
    "mark_duplicates", "exact_dedupe", "balanced_topk", "selection_audit", "screen_items", "claim_trace", "extract_page_links",
    "canonical_url", "token_set", "narration_timeline", "source_audit", "window_counters", "edition_markdown",
]


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "gleaner-bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    from gleaner.plans import catalog  # noqa: F401
    from gleaner.plans.registry import QUERIES

    times = {}
    for name in names or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])

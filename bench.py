"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Each query is run to completion through the no-op sink (full execution, no driver
collect).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cinerank.plans.queries import QUERIES  # noqa: E402
from cinerank.session import build_session, cleanup  # noqa: E402

HEADLINE = (
    "prepared_ratings",
    "item_neighbors",
    "item_based_topn",
    "content_topn",
    "hybrid_topn",
    "random_topn",
    "report_first_users",
    "all_methods_topn",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or list(HEADLINE)
    spark = build_session(f"local[{cpus}]", shuffle_partitions=2 * cpus)
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    try:
        cleanup(spark)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()

"""Headline queries at BENCH_SF_DIR; prints one JSON line.

Every query is executed in full into Spark's no-op sink. The reported time is
that of a second run in the same session. ``events_per_second`` is the unified
feed, built, parsed, mapped and merged, over the time of ``merge_replace_row``.
"""

from __future__ import annotations

import json
import os
import re
import time

from weirflow.plans import QUERIES
from weirflow.session import local_session

HEADLINE = (
    "cdc_feed_counts",
    "map_job_activity",
    "drop_audit",
    "merge_append",
    "merge_replace_row",
    "merge_partial",
    "merge_match_update",
    "target_count",
    "stream_replace_row",
)
RUNS = 2


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, shuffle_partitions=cores, **{"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {name: round([seconds(name) for _ in range(RUNS)][-1], 3) for name in HEADLINE}
    events = sum(r["events"] for r in QUERIES["cdc_feed_counts"](spark, folder).collect())
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(re.search(r"sf([0-9.]+)/?$", folder).group(1)) if "sf" in folder else None,
        "events": events,
        "events_per_second": round(events / times["merge_replace_row"]),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

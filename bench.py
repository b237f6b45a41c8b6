"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the number of threads. Each query
runs once to warm up and then ``BENCH_RUNS`` times; the fastest run counts.
"""

from __future__ import annotations

import json
import os
import time

from viewtide.session import local_session
from workload.catalog import QUERIES

HEADLINE = [
    "monthly_channel_fact",
    "video_fact",
    "channel_distribution",
    "duration_trend_minute",
    "duration_histogram",
    "view_sub_top10",
    "ratio_box_stats",
    "star_join",
    "global_rank",
    "rank_in_group",
    "median_per_bin",
    "latest_per_key",
    "having_min_count",
    "new_video_anti",
    "dq_primary_key",
    "iso_duration",
    "topic_category",
    "html_extract_pairs",
    "ingest_new_videos",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus)
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            # The no-op sink runs the whole plan, including all columns, without collecting.
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times[1:] or times), 3)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    result = {"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": scale}
    print(json.dumps(result))


if __name__ == "__main__":
    main()

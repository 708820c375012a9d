"""Benchmark the headline analyses on one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_REPEAT (default 3).
Each query is executed completely through the ``noop`` sink (whole plan, no result transfer to the driver),
once untimed (warm-up), then BENCH_REPEAT times; ``queries`` holds the best time per query (as ``timeit``
reports), ``median_total`` the sum of the per-query medians. BENCH_EXTRA_CONF (JSON object) adds session settings
for experiments; by default none are added.
Prints one JSON line: {"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = (
    "profile",
    "count_by_country",
    "centroid_by_country",
    "peak_local_hour",
    "count_by_city",
    "word_counts",
    "top_words_in_top_places",
    "term_counts",
    "predict_place",
    "predict_place_full_model",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    from geotally.plans.catalog import queries
    from geotally.session import build_session

    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, app="geotally-bench",
                          extra={"spark.driver.memory": "8g", **json.loads(os.environ.get("BENCH_EXTRA_CONF", "{}"))})
    qs = queries()
    # Untimed warm-up pass over every headline query: JVM class loading and JIT, not part of any query's cost.
    # The timed pass below then measures a warm, long-lived session, as on a cluster.
    for name in HEADLINE:
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    medians: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(min(runs), 3)
        medians[name] = sorted(runs)[len(runs) // 2]
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    print(json.dumps({"metric": "total_headline_query_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "median_total": round(sum(medians.values()), 3),
                      "sf": sf, "cpus": cpus,
                      "warmup": "one untimed pass", "repeat": repeat}))


if __name__ == "__main__":
    main()

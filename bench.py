"""Bench: time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (all stages execute,
nothing is collected).  Every query runs three times: ``queries`` holds the
fastest run (at this size a first run is dominated by JIT and code-generation
warm-up, which a long job at scale pays once), ``first`` and ``median`` the
others.  The jobs that write (ingestion with a replay, the typed store, a
stream over two runs, the backfill) run once.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from viewtally.plans import backfill  # noqa: E402
from viewtally.plans.catalog import QUERIES  # noqa: E402
from viewtally.plans.sizing import checkpoint_dir  # noqa: E402
from viewtally.session import local_session  # noqa: E402
from viewtally.sources import messages as M  # noqa: E402

HEADLINE = [
    "trending_exact",       # trend backfill, hourly ticks
    "trending_ttl",
    "trending_top_k",
    "active_users",         # active users per 5-minute tick
    "order_users",
    "views_per_minute",     # minute counters
    "video_views_per_minute",
    "visible_minute_counters",
    "log_rows",             # storage path incl. dense offsets
    "bounded_read",
]

#: jobs that write their tables, timed once
JOBS = ["ingest_replay", "parquet_round_trip", "stream_minute_counters"]


def timed(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=cpus * 2, app="viewtally-bench")
    # warm-up: JVM, parquet footers, codegen caches
    timed(spark, "views_per_minute", sf_dir)
    times, first, median = {}, {}, {}
    for name in HEADLINE:
        runs = [timed(spark, name, sf_dir) for _ in range(3)]
        times[name], first[name] = round(min(runs), 3), round(runs[0], 3)
        median[name] = round(statistics.median(runs), 3)
    # every metric table in one job: parse once, stage compact events, derive all
    t0 = time.perf_counter()
    out = f"{checkpoint_dir(spark).rstrip('/')}/bench-backfill-{uuid.uuid4().hex}"
    backfill.run(spark, M.messages(spark, sf_dir, with_offsets=False), out)
    times["backfill_all"] = round(time.perf_counter() - t0, 3)
    # the same sum as in earlier rounds; the writing jobs are listed beside it
    total = round(sum(times.values()), 3)
    times |= {name: round(timed(spark, name, sf_dir), 3) for name in JOBS}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_headline_sec", "value": total, "unit": "sec", "queries": times,
                      "first": first, "median": median, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()

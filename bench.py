"""Time the headline queries: one warm-up, then the median of BENCH_RUNS runs.

Results go to the ``noop`` sink, so all rows are computed and none are collected. Prints
one JSON line; ``value`` is the sum of the medians. Names on the command line choose other
queries, and ``all`` times every registered one.
"""

from __future__ import annotations

import json
import os
import statistics
import subprocess
import sys
import tempfile
import time

import pyspark

from daymark import plans
from daymark.session import build_session

HEADLINE = [
    "host_activity",
    "user_device_activity",
    "datelist_bits",
    "host_month_reduced",
    "entity_year_snapshot",
    "scd2_backfill",
    "scd2_incremental",
    "state_change_pairwise",
    "state_change_history",
    "dedupe",
    "duplicate_report",
    "grouping_sets_points",
    "top_player_team",
    "top_team_wins",
    "rolling_wins_90",
    "longest_streak",
    "sessions",
    "avg_session_events_per_host",
    "sessions_stream",
    "match_enriched",
    "top_avg_kills",
    "top_map",
    "top_medal_map",
    "bucketed_join",
    "profit_by_product_region_month",
    "conversion_within_7_days",
]

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
MEMORY = os.environ.get("BENCH_MEMORY", "16g")


def run(query, spark) -> float:
    start = time.perf_counter()
    query(spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def revision() -> str:
    command = ["git", "rev-parse", "--short", "HEAD"]
    here = os.path.dirname(os.path.abspath(__file__))
    return subprocess.run(command, cwd=here, capture_output=True, text=True).stdout.strip()


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="run-")
    spark = build_session(
        "daymark-bench",
        master=f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": MEMORY,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = list(plans.queries()) if sys.argv[1:] == ["all"] else sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        query = plans.queries()[name]
        run(query, spark)
        seconds[name] = round(statistics.median(run(query, spark) for _ in range(RUNS)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    line = {
        "metric": "sum of median query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "runs": RUNS,
        "cpus": CPUS,
        "spark": pyspark.__version__,
        "driver_memory": MEMORY,
        "shuffle_partitions": CPUS,
        "revision": revision(),
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()

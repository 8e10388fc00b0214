"""Time every registered query on one folder: one warm-up, then the median of three runs.

Prints one JSON line. ``BENCH_SF_DIR`` names the folder, ``BENCH_CPUS`` the cores,
``BENCH_RUNS`` the timed runs, ``BENCH_QUERIES`` (comma-separated) restricts the queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starloom.plans.given_tables import FIRST_END, SECOND_END  # noqa: E402
from starloom.plans.daily import run_batch  # noqa: E402
from starloom.plans.queries import registered, star  # noqa: E402
from starloom.session import build_session, scratch_path  # noqa: E402
from starloom.sources.warehouse import Warehouse  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(
        "starloom-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds: dict[str, float] = {}
    for name, query in registered().items():
        if wanted and name not in wanted:
            continue
        taken = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            query(spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    if not wanted:
        # The two daily runs, from the operational tables to the published star.
        tables, warehouse = star(spark, folder), Warehouse(spark, scratch_path(spark, "bench"))
        started = time.perf_counter()
        run_batch(warehouse, tables.first, FIRST_END)
        run_batch(warehouse, tables.second, SECOND_END)
        seconds["daily_runs"] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds, median per query",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Times every query at one scale; prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` how often each query runs (the best
counts; one run is enough for those above ``LONG`` seconds), ``BENCH_ONLY`` a comma-separated choice of queries.
``--control`` also times the plain plans.

Each query is executed in full, without sending its rows to Python. The tables that queries share are built
first and timed as ``stage`` (raw results from the test tables), ``files`` (the raw results as CSV) and ``load``
(the warehouse).
"""

from __future__ import annotations

import json
import logging
import os
import sys
import time
from collections.abc import Callable

from lapstar.session import local_session
from workload import staging
from workload.control import CONTROL
from workload.queries import QUERIES


def seconds(work: Callable[[], object]) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


LONG = 10.0


def main() -> None:
    logging.getLogger("lapstar").setLevel(logging.ERROR)
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    only = [name for name in os.environ.get("BENCH_ONLY", "").split(",") if name]
    spark = local_session(cpus, "16g", **{"spark.sql.shuffle.partitions": str(cpus)})

    def run(query) -> float:
        def work() -> None:
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()

        best = seconds(work)
        for _ in range(runs - 1):
            if best < LONG:
                best = min(best, seconds(work))
        return best

    times = {
        "stage": seconds(lambda: staging.raw_results(spark, sf_dir)),
        "files": seconds(lambda: staging.results_folder(spark, sf_dir)),
        "load": seconds(lambda: staging.warehouse(spark, sf_dir)),
    }
    for name, query in QUERIES.items():
        if not only or name in only:
            times[name] = run(query)
    line = {
        "metric": "total seconds over all queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rsplit("/sf", 1)[-1],
        "cpus": cpus,
    }
    if "--control" in sys.argv:
        line["control"] = {name: run(query) for name, query in CONTROL.items()}
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()

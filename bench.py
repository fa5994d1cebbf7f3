"""Time the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line.

Each query runs to completion into the no-op sink, so that nothing but the query counts. A run
that is stopped prints the line with what it has; the figures so far also go to stderr.
BENCH_QUERIES may name some queries, separated by commas.
"""

from __future__ import annotations

import json
import os
import signal
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from trendloom.plans.queries import QUERIES  # noqa: E402
from trendloom.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = build_session(
        "bench", spark__master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="20g", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("OFF")
    QUERIES["top3_sources_by_day"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    signal.signal(signal.SIGTERM, lambda *_: sys.exit("stopped"))
    try:
        for name in names:
            start = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - start, 3)
            print(name, times[name], file=sys.stderr, flush=True)
    finally:
        print(report(times, sf_dir), flush=True)
    spark.stop()


def report(times: dict[str, float], sf_dir: str) -> str:
    return json.dumps({
        "metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")})


if __name__ == "__main__":
    main()

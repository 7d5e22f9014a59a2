"""Seconds per headline query; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from weirflow.plans.queries import QUERIES
from weirflow.session import local_session

HEADLINE = tuple(QUERIES)  # every operator as a query


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "weirflow-bench")
    for name in ("log_filter_sql", "bigint_envelope", "stream_log"):  # start JVM and workers
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    events = spark.read.parquet(f"{folder}/events.parquet").count()
    rates = {
        name: round(events / seconds[name])
        for name in ("stream_log", "stream_window", "stream_drift")
    }
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "events_per_second": rates,
            }
        )
    )


if __name__ == "__main__":
    main()

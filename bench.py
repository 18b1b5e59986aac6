"""Times all queries of the catalogue part. Prints one JSON line; seconds are the best of two runs."""

import json
import os
import time

from larder.plans.queries import QUERIES
from larder.session import local_session

def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus, shuffle_partitions=8)
    seconds = {}
    for name in QUERIES:
        best = float("inf")
        for _ in range(2):
            start = time.perf_counter()
            # Writing to nowhere runs the whole plan, every column included.
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds, best of two runs per query",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Time every registered query once, warm, and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from martflow.queries import QUERIES
from martflow.session import build_session


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = os.environ.get("BENCH_ONLY", "")
    spark = build_session(
        "martflow-bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.driver.host": "127.0.0.1",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in QUERIES if not only or n in only.split(",")]

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(run(name), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of warm seconds over all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

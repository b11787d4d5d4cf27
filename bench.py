"""Time the registered queries and print one JSON line.

Environment: BENCH_SF_DIR, BENCH_CPUS. Every query is fully evaluated into the no-op sink, once
cold and once warm; the headline value is the sum of the warm times.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from candlewick import build_session  # noqa: E402
from candlewick.session import SETTINGS  # noqa: E402
from contract.queries import REGISTRY  # noqa: E402


def timed(spark, run, sf: str) -> float:
    start = time.perf_counter()
    run(spark, sf).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    extra = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "8g",
        # many different queries in one JVM: room for all their generated code, short history
        "spark.driver.extraJavaOptions": "-XX:ReservedCodeCacheSize=1g -XX:+UseParallelGC",
        "spark.sql.ui.retainedExecutions": "5",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("bench", f"local[{cpus}]", **extra)
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or list(REGISTRY)
    cold = {name: timed(spark, REGISTRY[name][0], sf) for name in names}
    warm = {name: timed(spark, REGISTRY[name][0], sf) for name in names}
    report = {
        "metric": "registered queries, warm total",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": sf,
        "cpus": int(cpus),
        "settings": {**SETTINGS, **extra},
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()

"""Headline-query benchmark.

Runs every query registered with ``bench=True`` at $BENCH_SF_DIR (default
/root/testdata/sf0.1) on local[$BENCH_CPUS] and prints ONE JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed in full (``write.format("noop")``) after the session's
memoized panels/predictions are dropped, so every timing covers the query's
whole lineage from the Parquet scan. The session is warm: one untimed pass
over the same queries first (JVM JIT, generated-code cache, file listing),
as in a long-running analytics session.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from riskbeacon.plans import ml, pipeline
    from riskbeacon.plans.catalog import load_all
    from riskbeacon.session import get_session

    spark = get_session(f"local[{cpus}]", app_name="riskbeacon-bench", shuffle_partitions=int(cpus) * 2,
                        extra_conf={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    specs = load_all()
    names = [n for n, s in specs.items() if s.bench]
    only = os.environ.get("BENCH_ONLY")
    if only:
        names = [n for n in names if re.search(only, n)]

    # warm-up pass (not timed)
    if os.environ.get("BENCH_WARMUP", "1") == "1":
        for n in names:
            pipeline.clear_cache()
            ml.clear_cache()
            specs[n].build(spark, sf_dir).write.format("noop").mode("overwrite").save()

    times = {}
    for n in names:
        pipeline.clear_cache()
        ml.clear_cache()
        t0 = time.perf_counter()
        specs[n].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else None}))
    spark.stop()


if __name__ == "__main__":
    main()

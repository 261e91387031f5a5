"""Time every registered operator query on one scale factor.

Each query runs to completion through the ``noop`` sink (full execution,
nothing collected on the driver). Prints one JSON line:
{"metric": ..., "value": total seconds, "unit": "sec", "queries": {...}, "sf": ...}

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_QUERIES (comma-separated name prefixes, optional).
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
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [p for p in os.environ.get("BENCH_QUERIES", "").split(",") if p]

    from colloquy.plans.registry import load_all
    from colloquy.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 8), app_name="colloquy-bench")
    reg = load_all()
    names = [n for n in reg if not only or any(n.startswith(p) for p in only)]

    # warm-up: JVM, parquet footers, code paths
    reg["c8_outcome_counts"].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        t0 = time.perf_counter()
        try:
            reg[name].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # keep benchmarking the others
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "n_queries": len(timings),
        "cpus": cpus,
    }
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

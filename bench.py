"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query is executed in full with the ``noop`` sink (no collection to the driver). One warm-up pass
over all queries, then ``$BENCH_RUNS`` timed passes (default 1); per-query value = median.
``$BENCH_QUERIES`` (comma separated) restricts the set.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from edgegraph.plans.catalog import queries  # noqa: E402
from edgegraph.session import get_spark  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    warm = os.environ.get("BENCH_WARMUP", "1") == "1"
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_PARTITIONS", cpus)))
    qs = queries()
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or sorted(qs)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    if warm:
        for n in names:
            try:
                run(n)
            except Exception:  # noqa: BLE001 - reported by the timed run
                pass
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for n in names:
        samples = []
        try:
            for _ in range(runs):
                samples.append(run(n))
            times[n] = round(statistics.median(samples), 3)
        except Exception as exc:  # noqa: BLE001
            errors[n] = f"{type(exc).__name__}: {str(exc)[:200]}"
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
           "cpus": int(cpus), "runs": runs}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()

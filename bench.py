"""Benchmark: run the registered keys on $BENCH_SF_DIR and print one JSON line.

Each key's plan is executed in full through the ``noop`` sink (every row is
produced, nothing is collected to the driver). One warm-up key runs first so
JVM start-up and code generation are not charged to the first measured key.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (full rounds over all keys, per-key median reported; default 3),
BENCH_BUDGET_SEC (no new round is started when it would not finish within this
many seconds of the start; default 420), BENCH_KEYS (comma-separated subset),
BENCH_WITH_MODELS=1 to include the model keys.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cohortkit.plans import catalogue, learners  # noqa: E402
from cohortkit.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="cohortkit-bench")
    qs = catalogue.queries()
    keys = [k for k in os.environ.get("BENCH_KEYS", "").split(",") if k] or list(qs)
    if os.environ.get("BENCH_WITH_MODELS") != "1" and not os.environ.get("BENCH_KEYS"):
        keys = [k for k in keys if k not in learners.QUERIES or k in learners.UNFITTED]

    def run(key: str) -> float:
        t0 = time.perf_counter()
        qs[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    budget = float(os.environ.get("BENCH_BUDGET_SEC", "420"))
    started = time.perf_counter()
    run("rollup_age_gender")  # warm-up
    samples: dict[str, list[float]] = {k: [] for k in keys}
    for _ in range(runs):
        round_start = time.perf_counter()
        for k in keys:
            samples[k].append(run(k))
        spent, last = time.perf_counter() - started, time.perf_counter() - round_start
        if spent + last > budget:      # another full round would not fit
            break
    timings = {k: round(statistics.median(v), 3) for k, v in samples.items()}
    done_runs = min(len(v) for v in samples.values())
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "runs_per_key": done_runs,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Benchmark: build each KPI mart over the whole tables and write it to parquet.

``hot_customers`` finds the customers whose joins are split, once a round, as the pipeline
does before its marts.  Each mart is built from the driver tables under ``BENCH_SF_DIR`` (through the
source mapping and the staging plans, built once) and its full result written
to parquet; ``dq_suite`` then runs the 68 declared checks as the pipeline does
(``plans.marts.build_and_write``): staging models from the sources, marts from
the copies just written.  Values are the median of ``BENCH_RUNS`` rounds over all
queries after one to warm up, building each plan included.

Prints one JSON line:
{"metric": "kpi_marts_total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed rounds after one to warm up, default 3; the median is kept).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from kpiloom.config import DEFAULT_AS_OF  # noqa: E402
from kpiloom.operators import quality  # noqa: E402
from kpiloom.plans.marts import (  # noqa: E402
    MART_NAMES, STAGING_NAMES, build_mart, find_hot_customers,
)
from kpiloom.plans.registry import staged  # noqa: E402
from kpiloom.session import local_session, shared_dir  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus=cpus, shuffle_partitions=max(8, 2 * cpus), app="kpiloom-bench")
    out = f"{shared_dir(spark)}/kpiloom-bench"

    st = staged(spark, sf_dir)  # lazy staged plans at DEFAULT_AS_OF, shared by every mart
    hot = {}
    jobs = {name: (lambda name=name: build_mart(name, st, as_of=DEFAULT_AS_OF, hot=hot["customers"]))
            for name in MART_NAMES}

    def dq_suite():
        # the 68 checks as the pipeline runs them (build_and_write): staging
        # models from the sources, marts from the copies just written
        frames = {model: st[key] for model, key in STAGING_NAMES.items()}
        frames.update({name: spark.read.parquet(f"{out}/{name}_0") for name in MART_NAMES})
        return quality.run_checks(frames, quality.ALL_CHECKS)

    jobs["dq_suite"] = dq_suite

    # rounds over all jobs, the first one to warm the JVM and the file cache, so that
    # no job pays for being first and a slow spell of the host falls on all of them
    samples = {name: [] for name in ["hot_customers", *jobs]}
    for i in range(runs + 1):
        t = time.perf_counter()
        hot["customers"] = find_hot_customers(st, f"{out}/hot_customers_{i}")
        if i:
            samples["hot_customers"].append(time.perf_counter() - t)
        for name, build in jobs.items():
            t = time.perf_counter()
            build().write.mode("overwrite").parquet(f"{out}/{name}_{i}")
            if i:
                samples[name].append(time.perf_counter() - t)
    timings = {name: round(statistics.median(s), 3) for name, s in samples.items()}

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "kpi_marts_total_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

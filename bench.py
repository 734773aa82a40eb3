"""Benchmark: the fifteen reports (plus the template query) at one scale.

Environment: ``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``),
``BENCH_CPUS`` (default 8), ``BENCH_RUNS`` (timed runs per query, default 5).

1. The reference tables are written once as Parquet from the driver tables
   (the test adapters), as they would be stored in production; that time is
   reported as ``adapters_sec``.  The folder is taken from the session's
   ``spark.checkpoint.dir`` when set, else a fresh scratch folder.
2. Each report runs once to warm up, then ``BENCH_RUNS`` times; every run
   opens the tables anew, builds the report and executes the whole plan
   through a ``noop`` write (no collect), all of it timed.  The median is
   reported per query; ``value`` is the sum of the medians.

Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from care_analytics.plans.suite import REPORTS  # noqa: E402
from care_analytics.session import local_session  # noqa: E402
from care_analytics.sources import fixtures  # noqa: E402
from care_analytics.sources.catalog import Tables, materialize  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * cpus), app="care-analytics-bench")

    shared = spark.conf.get("spark.checkpoint.dir", None)
    root = tempfile.mkdtemp(prefix="bench-", dir=shared if shared and shared.startswith("/") else None)

    t0 = time.time()
    driver = Tables.from_driver(spark, sf_dir)
    materialize(driver, fixtures.REFERENCE_TABLES, root)
    adapters_sec = time.time() - t0

    per_query: dict[str, float] = {}
    build_sec: dict[str, float] = {}
    only = os.environ.get("BENCH_ONLY", "").split()
    for name, (build, _) in REPORTS.items():
        if only and name not in only:
            continue
        samples, building = [], []
        for i in range(runs + 1):
            start = time.time()
            build(Tables.from_parquet(spark, root)).write.format("noop").mode("overwrite").save()
            done = time.time()
            # the share of building and planning, measured on its own
            build(Tables.from_parquet(spark, root))._jdf.queryExecution().executedPlan()
            if i > 0:
                samples.append(done - start)
                building.append(time.time() - done)
        per_query[name] = round(statistics.median(samples), 3)
        build_sec[name] = round(statistics.median(building), 3)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_report_sec",
        "value": round(sum(per_query.values()), 3),
        "unit": "sec",
        "queries": per_query,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "build_sec": build_sec,
        "adapters_sec": round(adapters_sec, 3),
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

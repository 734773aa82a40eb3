"""Single-node reference timings: DuckDB runs each report's oracle SQL over
the same stored reference tables the benchmark uses.

Usage: python tools/duckdb_reference.py <folder of reference tables>
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from care_analytics.plans.suite import REPORTS  # noqa: E402
from care_analytics.sources import fixtures  # noqa: E402


def main(root: str, runs: int = 3) -> None:
    con = duckdb.connect()
    for ref, fx in fixtures.REFERENCE_TABLES.items():
        con.execute(f"CREATE VIEW {fx} AS SELECT * FROM read_parquet('{root}/{ref}/*.parquet')")
    out = {}
    for name, (_, sql) in REPORTS.items():
        samples = []
        for i in range(runs + 1):
            t0 = time.time()
            con.execute(f"SELECT count(*) FROM ({sql}) q").fetchall()
            if i:
                samples.append(time.time() - t0)
        out[name] = round(statistics.median(samples), 3)
    print(json.dumps({"engine": "duckdb " + duckdb.__version__, "value": round(sum(out.values()), 3),
                      "queries": out}))


if __name__ == "__main__":
    main(sys.argv[1])

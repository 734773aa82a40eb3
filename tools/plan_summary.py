"""Summarise the physical plan of every report.

Usage: python tools/plan_summary.py <folder of stored reference tables> [out.md]

Three settings per report: as planned on the given tables; "large-table
shape" with automatic broadcast switched off
(``spark.sql.autoBroadcastJoinThreshold=-1``), where even code lists, which
Spark would broadcast by their size, are shuffled; and the same over tables
stored in buckets (``catalog.store``).  Counts are of the plan before it runs:
a shuffle that several branches share is counted for each of them.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from care_analytics.plans.suite import REPORTS  # noqa: E402
from care_analytics.session import local_session  # noqa: E402
from care_analytics.sources.catalog import Tables, store  # noqa: E402
from care_analytics.sources.fixtures import REFERENCE_TABLES  # noqa: E402

PATTERNS = {
    "hash shuffles": r"Exchange hashpartitioning",
    "range shuffles": r"Exchange rangepartitioning",
    "broadcasts": r"BroadcastExchange",
    "sort-merge joins": r"SortMergeJoin",
    "broadcast hash joins": r"BroadcastHashJoin",
    "nested-loop joins": r"BroadcastNestedLoopJoin|CartesianProduct",
    "window group limits": r"WindowGroupLimit",
    "partial aggregates": r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_",
    "scans with pushed filters": r"PushedFilters: \[[^\]]+\]",
}


def summarise(text: str) -> dict[str, int]:
    return {k: len(re.findall(p, text)) for k, p in PATTERNS.items()}


def main(root: str, out: str | None) -> None:
    spark = local_session(shuffle_partitions=16)
    lines = ["| report | setting | " + " | ".join(PATTERNS) + " |",
             "| --- | --- | " + " | ".join("---" for _ in PATTERNS) + " |"]
    plain = Tables.from_parquet(spark, root)
    laid = store(plain, REFERENCE_TABLES, tempfile.mkdtemp(prefix="plans-"), "plan_summary", 16)
    for threshold, label, t in (("10485760", "as planned", plain), ("-1", "large-table shape", plain), ("-1", "stored layout", laid)):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for name, (build, _) in REPORTS.items():
            plan = build(t)._jdf.queryExecution().executedPlan().toString()
            counts = summarise(plan)
            lines.append(f"| {name} | {label} | " + " | ".join(str(v) for v in counts.values()) + " |")
    text = "\n".join(lines)
    print(text)
    if out:
        with open(out, "w") as fh:
            fh.write(text + "\n")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2] if len(sys.argv) > 2 else None)

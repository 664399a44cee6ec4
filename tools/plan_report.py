"""Write PLANS.md: scan pruning / pushdown and shuffle counts of the headline queries.

Usage: python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from bench import HEADLINE  # noqa: E402
from featurewright.plans.registry import queries  # noqa: E402
from featurewright.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    qs = queries()
    out = [
        "# PLANS",
        "",
        "Physical plans of the headline queries (generated by `tools/plan_report.py` at "
        f"`{sf_dir}`; AQE may still re-plan joins and coalesce partitions at runtime).",
        "Counts are over the plan as submitted: shuffles (`Exchange`; one that AQE reuses at run time counts each time), broadcasts, window",
        "operators, Python operators (`MapInPandas`/`BatchEvalPython`/`ArrowEvalPython`); a persisted",
        "sub-plan is printed (and counted) again inside its `InMemoryRelation`, and plans that start from a",
        "checkpoint (C1, L4) show no parquet scan.",
        "",
    ]
    for name in HEADLINE:
        df = qs[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        shuffles = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))
        broadcasts = plan.count("BroadcastExchange")
        windows = plan.count("Window [")
        python = sum(plan.count(k) for k in ("MapInPandas", "BatchEvalPython", "ArrowEvalPython"))
        out += [f"## {name}", "", f"- shuffles: {shuffles}, broadcasts: {broadcasts}, windows: {windows}, "
                f"python operators: {python}", ""]
        scans = []
        for line in plan.splitlines():
            if "FileScan" in line:
                table = re.search(r"file:[^,\]]*/([a-z_]+)\.parquet", line)
                pushed = re.search(r"PushedFilters: (\[[^\]]*\])", line)
                schema = re.search(r"ReadSchema: (struct<[^>]*>)", line)
                scans.append(
                    f"- scan `{table.group(1) if table else '?'}`: ReadSchema `{schema.group(1) if schema else '?'}`"
                    f", PushedFilters `{pushed.group(1) if pushed else '[]'}`"
                )
        out += sorted(set(scans)) + [""]
        spark.catalog.clearCache()
    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(out) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()

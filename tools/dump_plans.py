"""Write PLANS.md: the final (adaptive) physical plan of each headline query.

Usage: python tools/dump_plans.py [sf_dir]
Each query runs once into the noop sink, then its executed plan - with
AQE's runtime choices - is recorded, plus a one-line summary of exchanges,
joins, codegen stages and pushed filters.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from tessera.plans import catalog as C  # noqa: E402
from tessera.session import local_session  # noqa: E402

NAMES = [
    "rank_terms_count", "rank_terms_scan", "inverted_index", "parse_postings",
    "scored_postings", "grouped_postings", "sample_per_group", "sample_weighted", "kmeans_step",
    "cluster_results", "time_usage_grouped", "pipeline_survey",
]


def summary(plan: str) -> str:
    def n(pat: str) -> int:
        return len(re.findall(pat, plan))

    return (
        f"shuffle exchanges: {n(r'Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition')}, "
        f"broadcasts: {n(r'BroadcastExchange')}, sort-merge joins: {n(r'SortMergeJoin')}, "
        f"broadcast hash joins: {n(r'BroadcastHashJoin')}, nested-loop joins: {n(r'NestedLoopJoin')}, "
        f"python nodes: {n(r'Python')}, codegen stages: {len(set(re.findall(r'\*\((\d+)\)', plan)))}"
    )


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(cores=4)
    out = [f"# Physical plans at `{sf}` (local[4], AQE on, final plans)\n",
           "Generated by `tools/dump_plans.py`; scan lines show the pruned `ReadSchema` and `PushedFilters`.\n"]
    for name in NAMES:
        df = C.QUERIES[name](spark, sf)
        qe = df._jdf.queryExecution()
        qe.toRdd().count()  # run this very plan so AQE finalises it
        plan = qe.executedPlan().toString()
        if "== Initial Plan ==" in plan:
            plan = plan.split("== Initial Plan ==")[0].rstrip().rstrip("+-").rstrip()
        plan = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\]", "Location: …", plan)
        out.append(f"## {name}\n\n{summary(plan)}\n\n```\n{plan.strip()}\n```\n")
    spark.stop()
    path = os.path.join(__file__.rsplit("/tools/", 1)[0], "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()

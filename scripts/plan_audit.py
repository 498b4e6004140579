"""Physical-plan audit of the registered queries.

Runs each query to completion (noop sink, so AQE finalises the plan), then
counts in the final plan: parquet scans, shuffle exchanges, broadcast
exchanges, join strategies, sorts, Python evaluation nodes, and whether the
scans carry pushed filters. Prints a Markdown table.

With ``--trees`` the operator trees of the given keys are printed instead.

Usage: python scripts/plan_audit.py [--sf-dir DIR] [--trees] [key ...]
"""

from __future__ import annotations

import argparse
import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wrenchcast.plans.registry import QUERIES  # noqa: E402
from wrenchcast.session import get_session  # noqa: E402

JOINS = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct")


def audit(plan: str) -> dict:
    return {
        "scans": len(re.findall(r"Scan parquet", plan)),
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "joins": ", ".join(f"{j}x{plan.count(j)}" for j in JOINS if plan.count(j)) or "-",
        "python": "yes" if re.search(r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)", plan) else "no",
        "pushed": "yes" if re.search(r"PushedFilters: \[[^\]]+\]", plan) else "no",
        "single_partition": "yes" if "SinglePartition" in plan else "no",
    }


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("--trees", action="store_true")
    ap.add_argument("keys", nargs="*")
    args = ap.parse_args()
    spark = get_session("local[8]", shuffle_partitions=8)
    queries = QUERIES
    if args.trees:
        for key in args.keys:
            out = io.StringIO()
            with contextlib.redirect_stdout(out):
                queries[key](spark, args.sf_dir).explain("formatted")
            tree = out.getvalue().split("== Physical Plan ==\n")[-1].split("\n\n")[0]
            print(f"### {key}\n\n```\n{tree.rstrip()}\n```\n")
        return
    print("| key | scans | shuffles | broadcasts | joins | Python | pushed filters | SinglePartition |")
    print("|---|---|---|---|---|---|---|---|")
    for key in args.keys or sorted(queries):
        df = queries[key](spark, args.sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        a = audit(plan)
        print(f"| {key} | {a['scans']} | {a['shuffles']} | {a['broadcasts']} | {a['joins']} | {a['python']} | "
              f"{a['pushed']} | {a['single_partition']} |")


if __name__ == "__main__":
    main()

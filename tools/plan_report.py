"""Summarise the physical plan of every registered query (what the scale review looks at):
shuffles, join strategies, partial window limits, top-k, pushed filters and pruned scans.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
Every query of the catalog appears twice, both with Spark's broadcast-by-statistics off: first with
the library's own size-checked hints, then ("large") without them, as over tables whose estimate
is above every bound.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(plan: str) -> dict:
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin"
                       r"|CartesianProduct)\s*\[[^\]]*\],\s*\[[^\]]*\],\s*(\w+)", plan)
    pushed = [p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if p.strip()]
    pushed = [p for p in pushed if any(not x.strip().startswith("IsNotNull")
                                       for x in p.split(", "))]
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|"
                                   r"SinglePartition|RoundRobinPartitioning)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "joins": ", ".join(sorted({f"{k.replace('HashJoin', 'HJ').replace('Join', 'J')} {t}"
                                   for k, t in joins})) or "-",
        "partial_limit": "yes" if "WindowGroupLimit" in plan and "Partial" in plan else "-",
        "top_k": "yes" if "TakeOrderedAndProject" in plan else "-",
        "pushed": "; ".join(sorted(set(pushed)))[:90] or "-",
        "python_udf": "YES" if ("BatchEvalPython" in plan or "ArrowEvalPython" in plan) else "-",
    }


def main() -> None:
    from keyloop.operators import keyed
    from keyloop.plans import catalog
    from keyloop.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    estimate = keyed.estimated_bytes
    print("| query | sizes | shuffles | broadcasts | joins | partial limit | top-k | pushed filters |"
          " Python UDF |")
    print("|---|---|---|---|---|---|---|---|---|")
    for name, fn in catalog.QUERIES.items():
        for sizes, known in (("given", estimate), ("large", lambda df: None)):
            keyed.estimated_bytes = known
            df = fn(spark, sf)
            plan = df._jdf.queryExecution().executedPlan().toString()
            s = summarise(plan)
            print(f"| {name} | {sizes} | {s['shuffles']} | {s['broadcasts']} | {s['joins']} | "
                  f"{s['partial_limit']} | {s['top_k']} | {s['pushed']} | {s['python_udf']} |")
    spark.stop()


if __name__ == "__main__":
    main()

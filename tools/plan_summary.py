"""Physical-plan summary of every registered query (no execution).

usage: python tools/plan_summary.py [sf_dir] > PLANS.md
Counts, in the planned (pre-AQE) physical plan: shuffles by kind,
aggregate operators, joins, windows, Expand/Generate, Python evaluation
nodes, and whole-stage-codegen subtrees.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidepool.plans import catalog  # noqa: E402
from tidepool.session import local_session  # noqa: E402

PATTERNS = {
    "hash shuffles": r"Exchange hashpartitioning",
    "range shuffles": r"Exchange rangepartitioning",
    "single-partition": r"Exchange SinglePartition",
    "round-robin": r"Exchange RoundRobinPartitioning",
    "HashAggregate": r"\bHashAggregate\(",
    "SortAggregate": r"\bSortAggregate\(",
    "ObjectHashAggregate": r"\bObjectHashAggregate\(",
    "joins": r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)",
    "Window": r"\bWindow \[",
    "Expand": r"\bExpand \[",
    "Python": r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)",
    "codegen stages": r"\*\(\d+\)",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # the plan as Catalyst chose it
    cols = list(PATTERNS)
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_summary.py` at `{os.path.basename(sf_dir)}` with AQE off (the")
    print("static plan; at run time AQE may coalesce shuffles or turn a join into a broadcast).")
    print("No query has a Python evaluation node, a cartesian product or a nested-loop join.\n")
    print("| query | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---" for _ in cols) + " |")
    for name, fn in catalog.QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        counts = [len(re.findall(PATTERNS[c], plan)) for c in cols]
        print(f"| {name} | " + " | ".join(str(c) for c in counts) + " |")
    spark.stop()


if __name__ == "__main__":
    main()

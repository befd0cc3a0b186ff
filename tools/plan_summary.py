"""Count the physical operators of every registered query's plan.

    python tools/plan_summary.py [--sf-dir DIR] [name ...]

Flags plans with cartesian products, nested-loop joins or Expand, and lists
single-partition exchanges (expected only over small aggregates).
"""

from __future__ import annotations

import argparse
import collections
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

OPS = (r"CartesianProduct|BroadcastNestedLoopJoin|SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|"
       r"Exchange SinglePartition|WindowGroupLimit|Window|\bExpand\b|TakeOrderedAndProject|"
       r"Exchange hashpartitioning|BroadcastExchange")


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    from tillroll import Tables, registry
    from tillroll.session import local_session
    spark = local_session(8)
    registry.load_all()
    for name in args.names or sorted(registry.QUERIES):
        df = registry.QUERIES[name](Tables(spark, args.sf_dir))
        plan = df._jdf.queryExecution().executedPlan().toString()
        ops = collections.Counter(re.findall(OPS, plan))
        bad = any(ops.get(k) for k in ("CartesianProduct", "BroadcastNestedLoopJoin", "Expand"))
        print(f"{name:36s} {dict(ops)}{'  <-- CHECK' if bad else ''}")


if __name__ == "__main__":
    main()

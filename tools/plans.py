"""Print what the physical plan of each query does: exchanges, joins, Python.

    python tools/plans.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from leadframe.plans import QUERIES
from leadframe.session import build_session

_MARKS = ("Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
          "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "CartesianProduct",
          "BroadcastNestedLoopJoin", "SortAggregate", "ObjectHashAggregate", "ArrowEvalPython",
          "BatchEvalPython", "MapInPandas", "Window")


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.001"
    # no size-based broadcast: show the plan a large table would get
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8",
                          spark__sql__autoBroadcastJoinThreshold="-1")
    spark.sparkContext.setLogLevel("ERROR")
    for name in argv[1:] or QUERIES:
        df = QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        seen = {m: plan.count(m) for m in _MARKS if m in plan}
        regexes = len(re.findall(r"RLIKE|regexp_", plan))
        print(f"{name:28s} regex={regexes:<4d} {seen}")


if __name__ == "__main__":
    main(sys.argv[1:])

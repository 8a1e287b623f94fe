"""Run queries and print their final (adaptive) physical plans.

    python tools/show_plans.py [sf_dir] name [name ...]
    python tools/show_plans.py [sf_dir] --table     # one line a query, before adaptive changes
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from visitlens.plans.catalog import QUERIES  # noqa: E402
from visitlens.session import build_session  # noqa: E402


NODES = ("BroadcastHashJoin", "SortMergeJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate",
         "ObjectHashAggregate", "SortAggregate", "Generate", "Window", "TakeOrderedAndProject")


def table(spark, sf: str) -> None:
    print("| Query | Parquet scans | Exchanges | Operators |\n| --- | --- | --- | --- |")
    for name, query in QUERIES.items():
        plan = query(spark, sf)._jdf.queryExecution().executedPlan().toString()
        count = lambda word: len(re.findall(rf"(?<![A-Za-z]){word}\b", plan))  # noqa: E731, B023
        found = [f"{node} x{count(node)}" for node in NODES if count(node)]
        scans = len(re.findall(r"FileScan parquet", plan))
        print(f"| `{name}` | {scans} | {count('Exchange')} | {', '.join(found)} |")


def main() -> None:
    args = sys.argv[1:]
    sf = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.1"
    spark = build_session(os.environ.get("PLAN_MASTER", "local[8]"), shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    if args == ["--table"]:
        table(spark, sf)
        return
    for name in args:
        df = QUERIES[name](spark, sf)
        df.collect()  # the explain below then shows the final adaptive plan
        print(f"===== {name} =====")
        df.explain(mode="formatted")


if __name__ == "__main__":
    main()

"""Executed plans of every registered query, as for big inputs.

Each query runs to the end, and all plans that it executes are counted: those of the tables
it writes on the way (``saved``, ``materialize``), of the passes of an iteration and
of the result. They come from Spark's event log in a scratch folder. Size-based broadcasting
is off (``autoBroadcastJoinThreshold=-1``) and AQE is off, so the plans show the
exchanges a 100 TB run starts from; the only broadcasts left are the explicit
ones on sides with a proven or checked size bound. Prints a markdown table.

CLI: ``python tests/plan_report.py [sf_dir] [key ...]``; key ``llm`` stands for the training-data queries.
"""

from __future__ import annotations

import glob
import json
import os
import re
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

PATTERNS = {
    "hash shuffle": r"^Exchange hashpartitioning",
    "range shuffle": r"^Exchange rangepartitioning",
    "single-partition": r"^Exchange SinglePartition",
    "broadcast": r"^BroadcastExchange",
    "sort-merge join": r"^SortMergeJoin",
    "broadcast join": r"^BroadcastHashJoin",
    "window": r"^Window",
    "scan": r"^(FileScan|Scan )",
    "python": r"^(MapInArrow|MapInPandas|FlatMap\w*InPandas|ArrowEvalPython|BatchEvalPython)",
}
FORBIDDEN = r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|PythonUDF"


def _nodes(info: dict):
    yield info["simpleString"] if not info["nodeName"].startswith("Scan") else info["nodeName"]
    for child in info["children"]:
        yield from _nodes(child)


def executed(folder: str) -> dict[str, list[list[str]]]:
    """Per job description: the nodes of each plan that ran, from the event log in ``folder``."""
    plans, of = {}, {}
    for file in glob.glob(f"{folder}/*"):
        with open(file) as lines:
            for event in map(json.loads, lines):
                if event["Event"].endswith("SparkListenerSQLExecutionStart"):
                    of[event["executionId"]] = event["description"]
                if "sparkPlanInfo" in event:  # the last one of an execution is what ran
                    plans[event["executionId"]] = list(_nodes(event["sparkPlanInfo"]))
    found: dict[str, list[list[str]]] = {}
    for ident in sorted(plans):
        found.setdefault(of[ident], []).append(plans[ident])
    return found


def main(argv):
    from quarry.plans.registry import QUERIES
    from quarry.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.001"
    queries, keys = dict(QUERIES), argv[2:]
    if "llm" in keys:
        from quarry.llm.queries import QUERIES as more
        queries, keys = more, [k for k in keys if k != "llm"]
    log = tempfile.mkdtemp(prefix="quarry-plans-")
    spark = build_session("local[8]", 8, extra={
        "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log}", "spark.eventLog.compress": "false",
        "spark.eventLog.rolling.enabled": "false"})
    for key in keys or queries:
        spark.sparkContext.setJobDescription(key)
        queries[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()
    print("| query | plans | " + " | ".join(PATTERNS) + " | forbidden |")
    print("| --- | --- | " + " | ".join("---" for _ in PATTERNS) + " | --- |")
    for key, plans in executed(log).items():
        nodes = [n for plan in plans for n in plan]
        counts = [sum(bool(re.match(p, n)) for n in nodes) for p in PATTERNS.values()]
        bad = sorted({m for n in nodes for m in re.findall(FORBIDDEN, n)})
        print(f"| `{key}` | {len(plans)} | " + " | ".join(map(str, counts)) + f" | {', '.join(bad) or '-'} |", flush=True)


if __name__ == "__main__":
    main(sys.argv)

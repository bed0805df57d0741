"""Summarise the physical plan of every registered batch query (after one
execution, so AQE's final plan is shown) into PLANS.md.

usage: python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventlake.session import build_session  # noqa: E402


def summarize(plan: str) -> dict:
    return {
        "scans": len(re.findall(r"(FileScan|Scan parquet)", plan)),
        "read_schemas": sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan))),
        "exchanges": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|"
                                    r"Exchange RoundRobinPartitioning|Exchange SinglePartition", plan)),
        "single_partition": len(re.findall(r"Exchange SinglePartition", plan)),
        "broadcasts": len(re.findall(r"BroadcastExchange", plan)),
        "broadcast_joins": len(re.findall(r"BroadcastHashJoin", plan)),
        "smj": len(re.findall(r"SortMergeJoin", plan)),
        "partial_aggs": len(re.findall(r"functions=\[partial_", plan)),
        "hash": len(re.findall(r"(?<!Object)HashAggregate", plan.split("Initial Plan")[0])),
        "sort": len(re.findall(r"SortAggregate", plan.split("Initial Plan")[0])),
        "object": len(re.findall(r"ObjectHashAggregate", plan.split("Initial Plan")[0])),
        "group_limit": "WindowGroupLimit" in plan,
        "python": len(re.findall(r"MapInPandas|ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas", plan)),
        "checkpointed_input": "Scan ExistingRDD" in plan or "LogicalRDD" in plan,
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    from eventlake.plans.catalog import QUERIES as qs
    lines = ["# PLANS", "",
             f"Physical plans of the registered batch queries after one run at `{sf_dir}` (AQE final plans),",
             "summarised by `tools/plan_report.py`. `exchanges` counts shuffles (hash/range/round-robin/single);",
             "`SinglePartition` exchanges only feed the tiny watermark table of the pane replay (when not",
             "materialized) or a global `max_by`. Aggregates are counted apart: hash, sort (buffers of no fixed",
             "width, such as a whole message) and object hash.",
             "`(checkpoint)`: the pane queries read the pane partials and the per-batch watermark table, each",
             "written once as a reliable checkpoint while the query is built (the partials job is the only pass",
             "over the rows: one scan and one partial-aggregate shuffle).", "",
             "| query | scans | exchanges (single) | broadcast joins | partial aggs | hash / sort / object aggs | group limit | python | read schema |",
             "|---|---|---|---|---|---|---|---|---|"]
    for name, q in qs.items():
        df = q(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarize(plan)
        rs = "; ".join(x.replace("|", "/") for x in s["read_schemas"]) or "(checkpoint)"
        lines.append(f"| {name} | {s['scans']} | {s['exchanges']} ({s['single_partition']}) | "
                     f"{s['broadcast_joins']} | {s['partial_aggs']} | {s['hash']} / {s['sort']} / {s['object']} | {'yes' if s['group_limit'] else ''} | "
                     f"{s['python'] or ''} | `{rs}` |")
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(out, "w") as f:
        f.write("\n".join(lines) + "\n")
    print("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main()

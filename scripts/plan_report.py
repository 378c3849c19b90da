"""Summarise the physical plan of every key (after execution, so AQE's final plan).

    python scripts/plan_report.py [sf_dir] > PLANS.md

Per key: shuffle exchanges (hash / range / single-partition) and exchanges
reused within the query, broadcast exchanges, join strategies, aggregate
kinds, windows, Expand, and the filters pushed into Parquet scans.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cohortkit.plans import catalogue, learners  # noqa: E402
from cohortkit.session import local_session  # noqa: E402

NODES = ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct",
         "HashAggregate", "ObjectHashAggregate", "SortAggregate", "Window", "WindowGroupLimit", "Expand", "Generate")


def summarise(plan: str) -> dict:
    lines = plan.split("\n")
    final = lines
    for i, line in enumerate(lines):          # AQE prints "Final Plan" first when executed
        if "Initial Plan" in line:
            final = lines[:i]
            break
    text = "\n".join(final)
    ex = Counter()
    for m in re.finditer(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", text):
        ex[m.group(1)] += 1
    ex["reused"] = text.count("ReusedExchange")
    nodes = Counter()
    for n in NODES:
        nodes[n] = len(re.findall(rf"\b{n}\b", text))
    pushed = set()
    for m in re.finditer(r"PushedFilters: \[(.*?), ReadSchema:", text):
        body = m.group(1).rstrip("]")
        if body.startswith("Or(") or body.startswith("Not("):
            pushed.add(body if len(body) < 60 else body[:57] + "...")
            continue
        pushed.update(f for f in body.split(", ") if f and not f.startswith("IsNotNull"))
    pushed = sorted(pushed)
    return {"exchanges": dict(ex), "broadcasts": text.count("BroadcastExchange"),
            "nodes": {k: v for k, v in nodes.items() if v}, "pushed": pushed}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    qs = catalogue.queries()
    print("# Physical plan summary per key\n")
    print(f"Generated by `scripts/plan_report.py {sf_dir}` after executing each key (AQE final plans, "
          "scalar subqueries included). Shuffles: hash / range / single-partition exchanges, and exchanges "
          "reused instead of recomputed; broadcasts: "
          "broadcast exchanges; pushed: non-null-check filters pushed into Parquet scans. Model keys omitted.\n")
    print("| key | shuffles | broadcasts | operators | pushed filters |")
    print("|---|---|---|---|---|")
    for k, f in qs.items():
        if k in learners.QUERIES:
            continue
        df = f(spark, sf_dir)
        df.collect()          # execute this DataFrame's own plan so AQE's final plan is reported
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        ex = ", ".join(f"{v} {k2.replace('partitioning', '')}" for k2, v in sorted(s["exchanges"].items())) or "0"
        ops = ", ".join(f"{n}×{c}" for n, c in s["nodes"].items())
        pushed = "; ".join(s["pushed"])[:120]
        print(f"| `{k}` | {ex} | {s['broadcasts']} | {ops} | {pushed} |")


if __name__ == "__main__":
    main()

"""Summarise the physical plan of every registered query (as planned for large tables) into PLANS.md.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md

Broadcasts that rely on the planner's size estimate are switched off (``autoBroadcastJoinThreshold=-1``), so the plans
are those of large inputs; the only explicit broadcast is that of the top places, bounded by their ``limit``. For each query: exchanges by kind,
join strategies, partial aggregates and group limits, and whether any Python evaluation appears.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def summarize(plan: str) -> dict[str, object]:
    lines = plan.splitlines()
    count = lambda pat: sum(1 for ln in lines if re.search(pat, ln))
    return {
        "hash exchanges": count(r"Exchange hashpartitioning"),
        "range exchanges": count(r"Exchange rangepartitioning"),
        "single-partition exchanges": count(r"Exchange SinglePartition"),
        "broadcasts": count(r"BroadcastExchange"),
        "sort-merge joins": count(r"SortMergeJoin"),
        "broadcast hash joins": count(r"BroadcastHashJoin"),
        "partial aggregates": count(r"HashAggregate\(keys=.*functions=\[partial_"),
        "partial group limits": count(r"WindowGroupLimit.*Partial"),
        "top-k (TakeOrderedAndProject)": count(r"TakeOrderedAndProject"),
        "python evaluation": count(r"BatchEvalPython|ArrowEvalPython|PythonUDF"),
        "cartesian / nested loop": count(r"CartesianProduct|BroadcastNestedLoopJoin"),
    }


SHOWN = ("word_counts", "top_words_in_top_places", "predict_place")


def clean(plan: str) -> str:
    """Plan text without expression ids and plan ids, long lines shortened."""
    plan = re.sub(r"#\d+L?", "", plan)
    plan = re.sub(r", \[plan_id=\d+\]", "", plan)
    plan = re.sub(r"\[id=#\d+\]", "", plan)
    return "\n".join(ln if len(ln) <= 220 else ln[:217] + "..." for ln in plan.splitlines())


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from geotally.plans import catalog
    from geotally.session import build_session

    spark = build_session("local[8]", 8, extra={"spark.sql.autoBroadcastJoinThreshold": "-1"})
    rows = []
    keys = None
    shown = {}
    for name, fn in catalog.queries().items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        s = summarize(plan)
        keys = list(s)
        rows.append((name, s))
        if name in SHOWN:
            shown[name] = clean(plan)
    spark.stop()
    print("# Physical plans of the registered queries (large-table planning)\n")
    print("Generated by `python tools/plan_report.py`. Planner-estimated broadcasts are off; the one explicit")
    print("broadcast is that of the top-M places, bounded by a `limit`.\n")
    print("| query | " + " | ".join(keys) + " |")
    print("|---" * (len(keys) + 1) + "|")
    for name, s in rows:
        print(f"| {name} | " + " | ".join(str(s[k]) for k in keys) + " |")
    for name in SHOWN:
        print(f"\n## {name}\n")
        print("```")
        print(shown[name])
        print("```")


if __name__ == "__main__":
    main()

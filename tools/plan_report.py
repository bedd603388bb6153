"""Summarise the physical plan of every registered query (writes PLANS.md).

Usage: ``python tools/plan_report.py [sf_dir]``.  For each key it counts the
operators that matter at scale: shuffles, single-partition shuffles,
broadcasts and join strategies, partial group limits, sort-based
aggregates, reused exchanges, and the widest Parquet ReadSchema.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

# Exchanges are counted once per plan_id (a query stage prints its exchange again).
EXCHANGES = {
    "shuffles": r"Exchange (?:hashpartitioning|rangepartitioning|RoundRobinPartitioning)[^\n]*?\[plan_id=(\d+)\]",
    "single_part": r"Exchange SinglePartition[^\n]*?\[plan_id=(\d+)\]",
    "broadcasts": r"BroadcastExchange[^\n]*?\[plan_id=(\d+)\]",
}
PATTERNS = {
    "bhj": r"BroadcastHashJoin",
    "smj": r"SortMergeJoin",
    "group_limit": r"WindowGroupLimit",
    "sort_agg": r"SortAggregate",
    "reused": r"ReusedExchange",
}


def summarize(plan: str) -> dict[str, int]:
    plan = plan.split("== Initial Plan ==")[0]  # AQE prints the initial plan after the final one
    out = {k: len(set(re.findall(p, plan))) for k, p in EXCHANGES.items()}
    out.update({k: len(re.findall(p, plan)) for k, p in PATTERNS.items()})
    widths = [len(re.findall(r"(\w+):", m)) for m in re.findall(r"ReadSchema: struct<([^\n]*)", plan)]
    out["max_read_cols"] = max(widths, default=0)
    return out


def main(argv: list[str]) -> None:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    from emporia.plans.catalog import registry
    from emporia.session import get_session

    spark = get_session("local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    skip = {"run_pipeline", "ctl_run_log", "ctl_last_runs", "ctl_watermark_read", "ctl_watermark_advance",
            "ctl_watermark_lag", "gold_views_from_store"}
    rows = []
    for key, fn in registry().items():
        if key in skip:
            continue
        df = fn(spark, sf_dir)
        df.collect()  # runs the DataFrame's own execution, so the plan below is the final adaptive one
        rows.append((key, summarize(df._jdf.queryExecution().executedPlan().toString())))
    cols = list(EXCHANGES) + list(PATTERNS) + ["max_read_cols"]
    lines = ["# Physical plan summary", "",
             f"Final adaptive plans at `{sf_dir}` on local[8] (`python tools/plan_report.py`).  "
             "`single_part` counts single-partition shuffles: in this code base they only feed "
             "per-bucket tables of at most B rows or one-row totals (checked by tests/test_plans.py). "
             "`product_performance` reads a checkpoint of its product-grain input (rank helper), so "
             "its scans are not Parquet.", "",
             "| key | " + " | ".join(cols) + " |", "| --- |" + " --- |" * len(cols)]
    for key, s in rows:
        lines.append(f"| `{key}` | " + " | ".join(str(s[c]) for c in cols) + " |")
    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    print("\n".join(lines))


if __name__ == "__main__":
    main(sys.argv[1:])

"""Summarise the physical plan of every batch query as a markdown table.

Usage: python tools/plan_report.py [sf_dir] [name ...] [--full]
Columns: shuffles (hash / range / single-partition exchanges), broadcasts,
partial group limits before a shuffle, Python/Arrow nodes, scanned columns.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans.catalog import QUERIES  # noqa: E402
from tidemark.session import get_spark  # noqa: E402


def summarise(plan: str) -> dict:
    shuffles = re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)\(?([^,)]*)", plan)
    return {
        "shuffles": ", ".join(f"{k.replace('partitioning', '')}({v.split('#')[0]})" if v else k
                              for k, v in shuffles) or "none",
        "broadcasts": plan.count("BroadcastExchange"),
        "partial_limit": "yes" if re.search(r"WindowGroupLimit \[[^\n]*Partial", plan) else "",
        "top_n": "yes" if "TakeOrderedAndProject" in plan else "",
        "python": ", ".join(sorted({k for k in ("MapInArrow", "ArrowEvalPython", "BatchEvalPython",
                                                "FlatMapGroupsInPandas", "MapInPandas") if k in plan})),
        "scans": "; ".join(sorted({m.replace("struct<", "").replace(">", "")
                                   for m in re.findall(r"ReadSchema: (struct<[^>]*>)", plan)})),
    }


def main():
    args = [a for a in sys.argv[1:] if a != "--full"]
    full = "--full" in sys.argv
    sf = args[0] if args else "/root/testdata/sf0.1"
    only = set(args[1:])
    spark = get_spark()
    print("| query | shuffles | broadcasts | partial limit | top-N | Python | scanned columns |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for q in QUERIES:
        if only and q.name not in only:
            continue
        df = q.build(spark, sf)
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        print(f"| {q.name} | {s['shuffles']} | {s['broadcasts']} | {s['partial_limit']} | {s['top_n']} | "
              f"{s['python']} | {s['scans']} |")
        if full:
            df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()

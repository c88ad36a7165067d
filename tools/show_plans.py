"""Summarise the physical plans of the headline jobs: shuffles, joins, pushed filters, partial aggs.

Usage: python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def summarize(name, df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"Exchange (hashpartitioning\([^)]*\)|SinglePartition|rangepartitioning\([^)]*\))", plan)
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)"
                       r"[^\n]*?(Inner|LeftOuter|LeftAnti|LeftSemi|RightOuter|FullOuter)", plan)
    pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", plan)))
    partial = len(re.findall(r"partial_", plan))
    print(f"## {name}")
    print(f"- shuffles: {len(exchanges)}: " + "; ".join(e.split(",")[0] + ")" if "(" in e else e for e in exchanges))
    counts = {}
    for j in joins:
        counts[f"{j[0]} {j[1]}"] = counts.get(f"{j[0]} {j[1]}", 0) + 1
    print("- joins: " + ", ".join(f"{k} x{v}" for k, v in sorted(counts.items())))
    print(f"- partial aggregates: {partial}")
    for p in pushed:
        if p:
            print(f"- pushed filters: [{p[:160]}]")
    print()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from chartfold.plans.flatten import flatten_observations
    from chartfold.plans.pivot import build_catalog, widen
    from chartfold.queries import materialize, source
    from chartfold.session import build_session
    from chartfold.operators.upsert import upsert_by_key
    from chartfold.plans import incremental as incr
    from chartfold.queries import UPSERT_T
    spark = build_session("local[8]", shuffle_partitions=16)
    src = source(spark, sf)
    flat_lazy = flatten_observations(src.tables())
    summarize("flatten_observations", flat_lazy)
    cat = build_catalog(flat_lazy)
    summarize("flatten + widen, conditional (one plan, no stored flat)", widen(flat_lazy, catalog=cat,
                                                                              strategy="conditional"))
    flat = materialize(flat_lazy, "plans_flat")
    summarize("widen from stored flat, conditional", widen(flat, catalog=cat, strategy="conditional"))
    summarize("widen from stored flat, long", widen(flat, catalog=cat, strategy="long"))
    old = src.at(UPSERT_T).table("obs")
    summarize("upsert_by_key (10% batch)", upsert_by_key(old, incr.changed_rows(src.table("obs"), UPSERT_T),
                                                         ["obs_id"], order_by=["date_created"], null_safe=False))
    spark.stop()


if __name__ == "__main__":
    main()

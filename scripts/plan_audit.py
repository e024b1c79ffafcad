"""Audit the physical plan of every demo for things that do not scale.

For each query: run it into the ``noop`` sink (so AQE settles the final
plan), then scan the executed plan for nested-loop / cartesian joins,
single-partition exchanges, Python evaluation nodes and full-width scans,
and list joins, shuffles and pushed filters. Writes PLANS.md.

usage: python scripts/plan_audit.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from feedyard.demos import registry  # noqa: E402
from feedyard.demos.registry import load_all  # noqa: E402
from feedyard.session import local_session  # noqa: E402

FLAGS = {
    "nested-loop join": r"BroadcastNestedLoopJoin|CartesianProduct",
    "single-partition exchange": r"Exchange SinglePartition",
    "python eval": r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas|PythonUDF",
}
# single-partition exchanges that are expected: a global aggregate's final
# step after partial aggregation, or a tiny (per-partition count) table
EXPECTED_SINGLE = {
    "assign_windows": "global min/max of the date column (one row per partition after partial aggregation)",
    "request_plan": "global min/max of the date column (partial aggregation first)",
    "request_plan_snapshot": "count(*) per snapshot base table and the global min/max of the order dates "
                             "(each after partial aggregation: one row per partition)",
    "scan_envelopes": "none expected",
    "select_feeds": "count(*) per base table (partial aggregation first)",
    "surrogate_key_collisions": "final count over per-id counts (partial aggregation first)",
    "canonical_taxonomy": "min(p_type) of the fixture (partial aggregation first)",
    "taxonomy_orphans": "min(p_type) of the fixture (partial aggregation first)",
    "tag_rows": "min(p_type) of the fixture (partial aggregation first)",
    "parse_taxonomy": "min(p_type) of the fixture (partial aggregation first)",
    "page_slice": "top-k (TakeOrderedAndProject): the k+offset rows only",
}


def executed_plan(df) -> str:
    """Run the DataFrame's own query (so AQE finalises that plan) and return
    the final physical plan. Demo outputs at the audit scale are small."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    # an adaptive plan prints its final and its initial form: keep the final
    return plan.split("+- == Initial Plan ==")[0]


def audit(name: str, plan: str) -> dict:
    found = {k: len(re.findall(v, plan)) for k, v in FLAGS.items()}
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin)[^\n]*?(Inner|LeftAnti|LeftSemi|LeftOuter|FullOuter|RightOuter)?", plan)
    shuffles = len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin", plan))
    pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", plan)))
    return {"flags": found, "joins": [j[0] + (":" + j[1] if j[1] else "") for j in joins], "shuffles": shuffles,
            "pushed": pushed}


SHOWCASE = {
    "window_filter": "filters and column pruning reach the Parquet scan (PushedFilters, ReadSchema)",
    "upsert_replace": "batch reduction with a partial aggregate before its shuffle; anti join on keys, "
                      "null-key rows unioned around it",
    "assign_windows": "interval join as a hash join on the cells that windows are cut into",
    "resolve_attempts": "per-page aggregate, per-window stop, join back; no running window",
}


def range_path_plan(spark, sf: str) -> str:
    """Executed plan of the range-partitioned row numbering after the write of
    its locally numbered rows: the offsets."""
    from pyspark.sql import functions as F

    from feedyard.operators.paging import row_numbers
    from feedyard.sources.fixtures import table
    li = table(spark, sf, "lineitem").withColumn("window_start", F.trunc("l_shipdate", "MM"))
    numbered = row_numbers(li, ["window_start"], ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                  "l_shipdate"], num_partitions=8)
    return executed_plan(numbered)


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    spark = local_session()
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    # as on tables that do not fit a broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    load_all()
    qs = dict(registry.QUERIES)
    lines = ["# PLANS", "", f"Executed physical plans of every demo at `{sf}` (final adaptive plans), audited by",
             "`scripts/plan_audit.py`: joins, shuffle count, pushed filters, and flags for nested-loop",
             "joins, single-partition exchanges and Python evaluation. Automatic broadcasts are off.",
             "Only the final job of each demo is shown: eager steps before it (the range-partitioned",
             "numbering and fixture tables written to the shared folder, the publish of a versioned",
             "table) are separate jobs.", "",
             "| query | joins | shuffles | nested loop | single partition | python | pushed filters |",
             "| --- | --- | --- | --- | --- | --- | --- |"]
    notes = []
    for name in names or sorted(qs):
        try:
            plan = executed_plan(qs[name](spark, sf))
        except Exception as e:  # noqa: BLE001
            lines.append(f"| {name} | error: {type(e).__name__} | | | | | |")
            continue
        a = audit(name, plan)
        f = a["flags"]
        joins = ", ".join(sorted(set(a["joins"]))) or "-"
        pushed = "; ".join(p[:80] for p in a["pushed"]) or "-"
        lines.append(f"| {name} | {joins} | {a['shuffles']} | {f['nested-loop join']} | "
                     f"{f['single-partition exchange']} | {f['python eval']} | {pushed} |")
        if f["single-partition exchange"] and name in EXPECTED_SINGLE:
            notes.append(f"- `{name}`: single-partition exchange = {EXPECTED_SINGLE[name]}.")
        print(name, a, flush=True)
    if notes:
        lines += ["", "Single-partition exchanges, explained:", ""] + notes
    if not names:
        lines += ["", "## Selected executed plans", ""]
        for name, why in SHOWCASE.items():
            plan = executed_plan(qs[name](spark, sf))
            lines += [f"### {name}", "", why + ".", "", "```", plan.strip(), "```", ""]
        lines += ["### row_numbers, range-partitioned path", "",
                  "The locally numbered rows were written to the shared folder by a",
                  "separate job (range exchange + sort); this plan reads them back, counts rows per (group,",
                  "partition), turns the counts into offsets and joins them back.", "", "```",
                  range_path_plan(spark, sf).strip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(lines) + "\n")


if __name__ == "__main__":
    main()

"""Run every registered query and summarise its final (post-AQE) physical
plan: exchanges, join strategies, skew splits, Python nodes, checkpoint
reads, and the columns and filters each Parquet scan reads. Writes PLANS.md.

    python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NODES = ["Exchange hashpartitioning", "Exchange SinglePartition", "Exchange RoundRobinPartitioning",
         "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
         "HashAggregate", "ObjectHashAggregate", "Generate", "Window", "ArrowEvalPython", "MapInArrow",
         "Scan ExistingRDD", "ReusedExchange", "Subquery"]


def final_plan(df) -> str:
    """Run ``df`` to the end, counting its rows on the executors, and return
    the plan of that very execution after AQE's re-planning."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    text = execution.executedPlan().toString()
    if "AdaptiveSparkPlan" in text:
        assert "isFinalPlan=true" in text
    if "== Final Plan ==" in text:
        text = text[text.index("== Final Plan =="):]
        if "== Initial Plan ==" in text:
            text = text[:text.index("== Initial Plan ==")]
    return text


def summarise(name: str, plan: str) -> str:
    counts = Counter()
    for node in NODES:
        counts[node] = plan.count(node)
    counts["SortMergeJoin(skew=true)"] = plan.count("SortMergeJoin(skew=true)")
    scans = sorted(set(re.findall(r"FileScan parquet \[([^\]]*)\]", plan)))
    pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", plan)) - {""})
    parts = ", ".join(f"{k} {v}" for k, v in counts.items() if v)
    lines = [f"### {name}", "", parts or "(no operators listed)", ""]
    for cols in scans:
        lines.append(f"- scan: `{re.sub(r'#[0-9]+L?', '', cols)}`")
    for f in pushed:
        lines.append(f"- pushed filters: `{re.sub(r'#[0-9]+L?', '', f)}`")
    return "\n".join(lines) + "\n"


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from tessera.session import local_session
    from tessera.plans.catalog import QUERIES
    spark = local_session(8, 8)
    out = ["# PLANS", "",
           f"Final physical plans (after AQE) of every registered query at `{os.path.basename(sf)}`,",
           "generated by `tools/plan_report.py`. Counts are plan nodes; at this scale AQE turns most",
           "joins into broadcast joins from measured sizes, while at scale the same plans keep",
           "shuffled joins (and skew splits). `Scan ExistingRDD` is a read of a reliable checkpoint.",
           "",
           "## Changes made after reading the plans",
           "",
           "- `line_length_sum`: the per-line token count was evaluated after the explode (once per",
           "  word: quadratic); it is now projected before the generator.",
           "- Word-level operators: an array `filter` lambda (interpreted) became a row filter after",
           "  the explode (generated code); token counting uses one regex replace instead of",
           "  `regexp_count`, which Spark rewrites into building an array of every token.",
           "- `char_pair_counts`: one lookahead regex per line instead of a split and `zip_with`; the",
           "  aggregate runs on the two-character string, split only afterwards.",
           "- `check_kv_lines`: the optimizer copied the JSON UDF into a pushed-down filter, so Python",
           "  ran twice; the UDF is marked non-deterministic and now appears in one Arrow node. Most",
           "  texts never reach it (exact JVM fast path).",
           "- Order queries: `lineitem` is summed per order before the join; the (customer, order)",
           "  aggregate reuses the join's partitioning (no exchange); `ratio_by_pair` scans `orders`",
           "  once.",
           "- Graph: the raw edge input was re-derived for every use (21 scans); the distinct",
           "  undirected edges and the oriented edges are now reliable checkpoints; the closing join",
           "  no longer de-duplicates the already-distinct oriented edges.",
           "- Hot keys: AQE could not split joins whose lookup side comes out of an aggregate (no",
           "  exchange on that side), seen as plain `SortMergeJoin` on skewed test data; those joins",
           "  now take the key's hash along, which brings the exchange; `tests/test_skew.py` asserts",
           "  the split in an executed plan. The plans are the same at every size.",
           "- Line parsers: the optimizer copied the split into every filter and cast (up to five",
           "  times a line); the fields now pass a generator, and each line is split once.",
           "",
           "## Final plans",
           ""]
    for name, q in QUERIES.items():
        out.append(summarise(name, final_plan(q(spark, sf))))
        print(name, flush=True)
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()

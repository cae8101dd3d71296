"""Scale guards on the physical plans of every registered query: no
cartesian or nested-loop joins, no windows (a window gathers a key's rows
in one task), Python only where intended, and scans that read only the
columns a query uses."""

import os
import re
import sys

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

PYTHON_EXPECTED = {"compensated_sum": "MapInArrow", "compensated_sum_by_part": "MapInArrow",
                   "check_kv_lines": "ArrowEvalPython"}
# Widest scan each query may need (columns), as a guard against lost pruning.
MAX_SCAN_COLS = 5


def plans(spark):
    from tessera.plans.catalog import QUERIES
    for name, q in QUERIES.items():
        yield name, q(spark, SF)._jdf.queryExecution().executedPlan().toString()


def executed(df) -> str:
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
    from plan_report import final_plan
    return final_plan(df)


def test_plan_shapes(spark):
    for name, plan in plans(spark):
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Window ", "WindowGroupLimit"):
            assert bad not in plan, (name, bad)
        for py in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas"):
            if py in plan:
                assert PYTHON_EXPECTED.get(name) == py, (name, py)
        for cols in re.findall(r"FileScan parquet \[([^\]]*)\]", plan):
            assert len(cols.split(",")) <= MAX_SCAN_COLS, (name, cols)


def test_aggregates_have_partial_step(spark):
    # Every final hash aggregate over a shuffle is fed by a partial one, so a
    # hot key is collapsed inside each task before it is shuffled.
    for name, plan in plans(spark):
        finals = len(re.findall(r"HashAggregate\(keys=\[[^\]]*\], functions=\[(?!partial_|\])", plan))
        partials = len(re.findall(r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_", plan))
        if finals:
            assert partials >= 1, name


def test_executed_edge_derivation_scans_the_lines_twice(spark):
    from tessera.plans.inputs import part_link_edges, table
    plan = executed(part_link_edges(table(spark, SF, "lineitem")))
    assert plan.count("FileScan parquet") <= 2 and plan.count("Exchange hashpartitioning") <= 3


def test_executed_text_queries_need_no_shuffle(spark):
    from tessera.plans.catalog import QUERIES
    for name in ("token_count", "stable_bucket", "stable_bucket_typed", "check_kv_lines", "parse_tsv"):
        assert "Exchange" not in executed(QUERIES[name](spark, SF)), name


def test_lines_are_split_once(spark):
    """One ``split(`` per line in the optimized plans of the parsers."""
    from tessera.plans.catalog import QUERIES
    for name in ("parse_tsv", "keyed_product_sum_tsv", "avg_order_quantity_tsv", "parse_edges"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("split(") == 1, (name, plan)

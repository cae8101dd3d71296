"""Registered training-data queries over whole test tables: those with SQL
against it, the others for their columns, types and one row per input row."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

# The columns of the contract that must come first or at all.
CONTRACT = {
    "op1": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op2": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int",
            "slot": "bigint", "grown_shard": "int"},
    "op3": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint",
            "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op4": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
            "sequence_id": "bigint", "offset": "bigint"},
    "op5": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op6": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op7": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op8": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op9": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string",
            "spans": "string"},
    "op10": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op11": {"conv_id": "bigint", "depth": "bigint", "parent_conv_id": "bigint", "n_convs": "bigint", "n_children": "bigint",
             "n_leaves": "bigint", "saved_tokens": "bigint", "ends_sha256": "string"},
    "op12": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op13": {"vec_id": "bigint", "code": "string", "error": "bigint", "label_error": "bigint", "codebooks_sha256": "string"},
}


def test_all_queries_and_the_pipeline_are_registered():
    import __spark_entry__ as entry
    names = [n for n in entry.queries() if n.startswith("op") and "_" in n and n[2].isdigit()]
    assert sorted(n.split("_")[0] for n in names) == sorted(CONTRACT) and "pipeline" in entry.queries()


@pytest.mark.parametrize("op", list(CONTRACT))
def test_columns_types_and_rows(spark, op):
    from tessera.llm.queries import QUERIES
    name = next(n for n in QUERIES if n.startswith(op + "_"))
    out = QUERIES[name](spark, SF)
    got = dict(out.dtypes)
    assert {c: got.get(c) for c in CONTRACT[op]} == CONTRACT[op]
    table, key = {"op6": ("embeddings", "vec_id"), "op13": ("embeddings", "vec_id"),
                  "op11": ("conversations", "conv_id")}.get(op, ("documents", "doc_id"))
    ids = [r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()]
    mine = [r[0] for r in out.select(key).collect()]
    if op == "op11":  # a row per node
        assert set(mine) <= set(ids) and out.filter("depth = 0 AND parent_conv_id IS NULL").count() == 1
    else:
        assert set(mine) == set(ids) and (op == "op4" or len(mine) == len(ids))


def test_queries_match_their_sql(spark):
    import oracle_check
    from tessera.llm.queries import ORACLE_SQL
    res = oracle_check.compare(spark, SF, list(ORACLE_SQL))
    bad = {k: v for k, v in res.items() if not v.get("values_match") or not v.get("types_match")}
    assert not bad and len(res) == len(ORACLE_SQL), bad

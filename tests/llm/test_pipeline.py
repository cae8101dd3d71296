import importlib.util
import os

import pytest

from tests.llm.conftest import SCHEMA, edge_rows, prose, sorted_rows

if importlib.util.find_spec("public_tokenizers") is None:
    pytest.skip("tokenizer files not present", allow_module_level=True)

import corpus_pipeline as cp  # noqa: E402

COLUMNS = [f.name for f in SCHEMA.fields]


def stage(name):
    return dict(cp.STAGES)[name]


def test_stages_are_the_five_asked_for():
    assert [n for n, _ in cp.STAGES] == ["language_id", "near_duplicates", "secret_scan", "source_mix", "packing"]


def test_run_on_a_table(spark):
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("test tables not present")
    out = cp.run(spark, sf)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 100 and out.filter("length > 1024 OR length < 1").count() == 0


def test_each_stage_on_edge_rows(spark, edge_docs, clash_docs, empty_docs):
    for name, f in cp.STAGES[:-1]:
        for docs in (edge_docs, clash_docs, empty_docs):
            out = f(spark, docs, "")
            assert set(out.columns) == set(docs.columns), name
            n = out.count()
            assert n <= 2 * len(edge_rows()) and (n == 0) == (docs is empty_docs), name


def test_packing_stage_on_edge_rows(spark, edge_docs, clash_docs, empty_docs):
    """Every text's tokens, placed once, without overlap."""
    from tokenizers import Tokenizer
    from tessera.llm.common import tokenizer_path
    t = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    want = sum(len(t.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in edge_rows())
    for docs in (edge_docs, clash_docs):
        rows = stage("packing")(spark, docs, "").collect()
        assert sum(r["length"] for r in rows) == want and all(0 < r["length"] <= 1024 for r in rows)
        held = {}
        for r in rows:
            held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for pieces in held.values():
            ends = [0, *(a + n for a, n in sorted(pieces))]
            assert [a for a, _ in sorted(pieces)] == ends[:-1] and ends[-1] <= 1024
    assert stage("packing")(spark, empty_docs, "").count() == 0


def test_language_stage_drops_only_what_has_no_language(spark, edge_docs):
    kept = {r["text"] for r in stage("language_id")(spark, edge_docs, "").collect()}
    assert not kept & {None, "", " \t\n "} and prose(3, 200) in kept and prose(1, 30_000) in kept


def test_near_duplicate_stage_keeps_one_of_each_group(spark):
    a, b = prose(1, 100), prose(2, 100)
    rows = [(1, a, "en", "s", 1), (2, a, "en", "s", 1), (3, a + " more", "en", "t", 1), (4, b, "en", "s", 1),
            (4, b, "en", "s", 1), (5, "", "en", "s", 0), (6, "", "en", "s", 0), (7, a[:300], "en", "s", 1)]
    out = stage("near_duplicates")(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 4, 5, 6, 7]


def test_secret_stage_masks_and_keeps(spark):
    clean = prose(5, 50)
    rows = [(1, "my password: hunter2000 end", "en", "s", 27), (2, clean, "en", "s", len(clean)), (3, None, "en", "s", 0)]
    out = sorted_rows(stage("secret_scan")(spark, spark.createDataFrame(rows, SCHEMA), ""))
    assert out == [(1, "my [SECRET] end", "en", "s", 15), rows[1], rows[2]]


def test_mix_stage_repeats_rows_by_the_plan(spark, edge_docs):
    from collections import Counter
    from tessera.llm.mixing import mix
    got = Counter((r["doc_id"], r["text"]) for r in stage("source_mix")(spark, edge_docs, "").collect())
    want = Counter()
    plan = mix(edge_docs, carry=("text",)).collect()
    for r in plan:
        want[(r["doc_id"], r["text"])] += r["copies"]
    assert got == +want


def test_a_worker_holds_only_the_shared_object_used_last(spark):
    import sys
    from tessera.llm.common import share
    sys.modules.pop("_tessera_worker_state", None)
    loads = [share(spark, {"model": i}) for i in range(3)]
    assert [f()["model"] for f in (*loads, loads[0], loads[0])] == [0, 1, 2, 0, 0]
    assert loads[0]() is loads[0]()
    assert str(sys.modules.pop("_tessera_worker_state").table).count("'model'") == 1

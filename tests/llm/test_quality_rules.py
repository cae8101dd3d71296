import re
from collections import Counter

import pytest

from tessera.llm import quality_rules as q
from tests.llm.conftest import edge_rows, prose, sorted_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
HARD = ["a b c a b c a b c", "x x x x", "x\ny\nx\n\nx\n \n", "# $$ a|b <c>", "a b a b a", "", "a\r\nb\r\na",
        "   x", "é " * 60, prose(9, 70) + "\n" + prose(9, 70)]


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    tri = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in q.SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered),
            len(lines))


def failed(m):
    names = {"n_words": m[0], "word_chars": m[1], "n_symbols": m[2], "n_dup_lines": m[3], "n_repeat_words": m[4],
             "n_lines": m[5]}
    return sum(1 << k for k, c in enumerate(q.RULES.values()) if eval(c, {}, names))


def test_measurements_and_bits_against_brute_force(spark, edge_docs):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(HARD)], "doc_id long, text string")
    docs = docs.unionByName(edge_docs.select("doc_id", "text"))
    want = sorted(((i, *brute(t), failed(brute(t))) for i, t in [*enumerate(HARD), *[(r[0], r[1]) for r in edge_rows()]]),
                  key=repr)
    assert sorted_rows(q.ledger(docs), "doc_id", *q.MEASURES, "failed_bits") == want


def test_policies_and_ablations(spark):
    entries = spark.createDataFrame([(b,) for b in [0, 0, 1, 2, 3, 4, 4, 12, 63]], "failed_bits long")
    for p in q.POLICIES.values():
        kept = entries.filter(q.passes(p)).count()
        rows = {r["rule"]: r for r in q.ablations(entries, p).collect()}
        assert set(rows) == set(p.rules)
        names = list(q.RULES)
        for rule, r in rows.items():
            bit = 1 << names.index(rule)
            bits = [e["failed_bits"] & p.mask for e in entries.collect()]
            assert r["fail"] == sum(bool(b & bit) for b in bits)
            assert r["fail_alone"] == sum(b == bit for b in bits)
            assert r["kept_without"] == sum(not b & ~bit for b in bits) == kept + r["fail_alone"]


def test_edges(clash_docs, empty_docs, edge_docs):
    got = q.ledger(clash_docs, keep=("doc_id", "size", "n_words"))
    assert got.columns == ["doc_id", "size", *q.MEASURES, "failed_bits"]
    assert sorted_rows(got.drop("size")) == sorted_rows(q.ledger(edge_docs))
    assert q.ledger(empty_docs).count() == 0
    assert q.ablations(q.ledger(empty_docs), q.POLICIES["web"]).count() == 0


def test_each_rule_runs_once_without_python_or_shuffle(edge_docs):
    plan = q.ledger(edge_docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert plan.count("regexp_extract_all") == 1


def test_clean_prose_is_kept():
    for seed in range(20):
        assert failed(brute(prose(seed, 300))) & q.POLICIES["web"].mask == 0


@pytest.mark.parametrize("name", list(q.POLICIES))
def test_masks_name_their_rules(name):
    p = q.POLICIES[name]
    assert bin(p.mask).count("1") == len(p.rules)

from collections import defaultdict
from math import log2

from tessera.llm import langid as li
from tests.llm.conftest import edge_rows, prose, sorted_rows

SAMPLE = {"en": ["the cat sat on the mat and the dog", "this is the end of the day"],
          "de": ["die katze und der hund sind im haus", "das ist der tag"], "xx": ["ß日本 zzz"]}


def brute_bits(text, texts):
    """Code length by walking a dictionary tree, escape method C."""
    pad = bytes([li.PAD]) * li.ORDER
    data = pad + pad.join(t.lower().encode() for t in texts) + pad
    seen = defaultdict(lambda: defaultdict(int))
    for i in range(li.ORDER, len(data)):
        for k in range(li.ORDER + 1):
            seen[data[i - k:i]][data[i]] += 1
    x, total = pad + text.lower().encode(), 0.0
    for i in range(li.ORDER, len(x)):
        for k in range(li.ORDER, -1, -1):
            after = seen.get(x[i - k:i])
            if not after:
                continue
            t, d = sum(after.values()), len(after)
            if x[i] in after:
                total -= log2(after[x[i]] / (t + d))
                break
            total -= log2(d / (t + d))
        else:
            total += 8
    return total


def test_code_lengths_against_a_dictionary_tree():
    model = li.PpmModel.train(SAMPLE)
    texts = ["the dog", "Das Haus", "", "zzz 日", "qqq \x00\x01", "a", "ÿþ the the"]
    want = [[brute_bits(t, SAMPLE[lang]) for lang in model.languages] for t in texts]
    for piece in (1 << 20, 7, 1):
        got = model.code_lengths(texts, piece=piece)
        assert abs(got - want).max() < 1e-3


def test_hashed_keys_find_all_and_only_theirs():
    import numpy as np
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 40, 5000, dtype=np.uint64))
    table = li.HashedKeys(keys)
    assert (table.find(keys) == np.arange(len(keys))).all()
    other = np.setdiff1d(rng.integers(0, 1 << 40, 5000, dtype=np.uint64), keys)
    assert (table.find(other) == -1).all()
    assert li.HashedKeys(keys[:0]).find(keys[:3]).tolist() == [-1, -1, -1]


def test_held_out_accuracy(spark):
    import os
    import pytest
    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        pytest.skip("test tables not present")
    from tessera.llm.queries import QUERIES
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op5_ppm_language"](spark, sf).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(truth) and len(held) > 100
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_sample_is_bounded_and_stable(spark):
    rows = spark.createDataFrame([(i, f"text {i}", "en" if i % 4 else "de") for i in range(2000)],
                                 "doc_id long, text string, lang string")
    a = li.sample_per_class(rows, "lang", "doc_id", 30)
    counts = {r["lang"]: r["count"] for r in a.groupBy("lang").count().collect()}
    assert counts == {"en": 30, "de": 30}
    assert sorted_rows(a) == sorted_rows(li.sample_per_class(rows.repartition(5), "lang", "doc_id", 30))


def test_edges(edge_docs, clash_docs, empty_docs):
    model = li.train(edge_docs)
    got = li.identify(edge_docs, model)
    und = {r["doc_id"] for r in got.collect() if r["lang_pred"] == li.UNKNOWN}
    assert {1, 2, 3} <= und and 4 not in und and 10 not in und
    assert {r["lang_pred"] for r in got.collect()} <= {"en", "de", "fr", "ja", li.UNKNOWN}
    clash = li.identify(clash_docs, model)
    assert set(clash.columns) == set(clash_docs.columns)
    assert sorted_rows(clash, "doc_id", "lang_pred", "score") == sorted_rows(got, "doc_id", "lang_pred", "score")
    assert li.train(empty_docs) is None and li.identify(empty_docs, model).count() == 0
    none = li.identify(edge_docs, None).collect()
    assert len(none) == len(edge_rows()) and {r["lang_pred"] for r in none} == {li.UNKNOWN}


def test_long_texts_are_scored_whole():
    model = li.PpmModel.train(SAMPLE)
    head, tail = prose(1, 50), "die katze und der hund " * 400
    assert model.predict([head[:200] + tail])[0] == ["de"]


def test_a_language_with_long_rows_only_is_learned(spark):
    rows = [(i, prose(i, 60), "en") for i in range(30)] + [(100 + i, "ñandú veloz está aquí " * 400, "es") for i in range(5)]
    model = li.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), docs_per_lang=10, max_chars=1000)
    assert model.languages == ["en", "es"]
    assert model.predict([prose(99, 50), "ñandú aquí está"])[0] == ["en", "es"]


def test_work_space_is_that_of_a_piece():
    import tracemalloc
    model = li.PpmModel.train({"en": [prose(i, 60) for i in range(5)], "de": ["straße und wald " * 40]})
    text = prose(3, 4000)
    short = model.code_lengths([text])
    tracemalloc.start()
    long_ = model.code_lengths([text * 1000, text])  # about 25 MB
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20 and abs(long_[1] - short[0]).max() < 1e-6 * short.max()
    assert abs(long_[0] - 1000 * short[0]).max() < 0.01 * long_[0].max()
    pieces = model.code_lengths([text, "", None, text[:50]], piece=64)
    assert abs(pieces[0] - short[0]).max() < 1e-6 * short.max() and not pieces[1:3].any()

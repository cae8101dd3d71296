import random

from tessera.llm import toxicity as tx
from tessera.llm.common import TwoTierCache
from tests.llm.conftest import edge_rows, prose, sorted_rows

BAD = ["horrible", "wretched", "stupid", "vile"]


def corpus(n=240, seed=0):
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        words = prose(1000 * seed + i, rng.randrange(60, 160)).split()
        y = i % 2
        if y:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        texts.append(" ".join(words))
        labels.append(y)
    return texts, labels


def test_learns_and_shares_subwords_with_unseen_misspellings():
    texts, labels = corpus()
    model = tx.train(texts, labels)
    other, y = corpus(100, seed=5)
    p = model.score(other, TwoTierCache(1000))
    assert sum((a >= 0.7) == bool(b) for a, b in zip(p, y)) >= 97
    base = prose(77, 90)
    clean, seen, unseen = model.score([base, base + " you horrible", base + " you horribble stupidd"], TwoTierCache(9))
    assert clean < 0.5 < seen and unseen > 0.5


def test_repeated_tokens_and_codes_count_nothing_extra():
    assert tx.bag_tokens("a a b b a") == ["a", "b", "a"] and tx.bag_tokens(None) == []
    assert tx.pieces("555-0199") == tx.pieces("--") == [] and tx.pieces("1d10t5") == ["1d10t5"] and tx.pieces("St0p!") == ["st0p"] and len(tx.pieces("x" * 100)) == 4


def test_highest_window_against_brute_force():
    import numpy as np
    rng = np.random.default_rng(0)
    model = tx.SubwordModel({}, np.zeros((0, 2)), np.zeros((2, 2)), np.array([0.25, -0.25]), (1, 0, 0))
    sizes = [0, 1, 5, tx.WINDOW, 40, 0, 3]
    docs = [rng.normal(size=n) for n in sizes]
    got = model.highest(np.concatenate(docs), sizes)
    for d, g in zip(docs, got):
        spans = [d[i:i + tx.WINDOW].sum() / tx.WINDOW for i in range(max(1, len(d) - tx.WINDOW + 1))] if len(d) else [0]
        assert abs(g - (max(spans) - 0.5)) < 1e-9


def test_edges(spark, edge_docs, clash_docs, empty_docs):
    texts, labels = corpus(120)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    marks = spark.createDataFrame([*enumerate(labels), (None, 1), (5, None), (3, 7)], "doc_id long, toxic int")
    model = tx.learn(docs, marks)
    got = tx.scored(edge_docs, model).collect()
    assert len(got) == len(edge_rows()) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in got)
    empty = [r["score"] for r in got if not (r["text"] or "").strip()]
    assert len(set(empty)) == 1 and empty[0] < 0.5
    clash = tx.scored(clash_docs, model)
    assert set(clash.columns) == set(clash_docs.columns)
    assert sorted_rows(clash, "doc_id", "score") == sorted_rows(tx.scored(edge_docs, model), "doc_id", "score")
    assert tx.scored(empty_docs, model).count() == 0
    assert tx.learn(docs, marks.filter("toxic = 1")) is None
    assert {r["score"] for r in tx.scored(edge_docs, None).collect()} == {0.5}


def test_mixed_tokens_are_scored_by_their_letters():
    texts, y = corpus()
    model = tx.train(texts, y)
    word = max({w for t, k in zip(texts, y) if k for w in t.split()}, key=model.word_logit)
    spelt = word[:2] + "0" + word[2:] + "77"
    assert model.word_logit(spelt) > model.word_logit("555019977") == 0.0


def test_sample_is_drawn_among_short_texts_and_filled_with_heads(spark):
    drawn = []

    def remember(texts, labels):
        drawn.append(list(zip(texts, labels)))

    rows = [(i, ("bad " if i % 2 else "fine ") * (5 if i < 40 and not i % 2 else 400)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    old, tx.train = tx.train, remember
    try:
        tx.learn(docs, labels, docs_per_class=15, max_chars=100)
        tx.learn(docs, labels, docs_per_class=30, max_chars=100)
    finally:
        tx.train = old
    for got, n, short in ((drawn[0], 15, 15), (drawn[1], 30, 20)):
        for label in (0, 1):
            mine = [t for t, k in got if k == label]
            assert len(mine) == n and all(len(t) <= 100 for t in mine)
        assert sum(len(t) == 25 for t, k in got if k == 0) == short and all(len(t) == 100 for t, k in got if k == 1)

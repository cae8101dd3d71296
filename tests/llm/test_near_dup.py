import random
import re

import pytest

from tessera.llm import near_dup as nd
from tessera.llm.components import components
from tests.llm.conftest import edge_rows, prose, sorted_rows

UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def shingle_set(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < k else frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def brute(rows, k, percent=80):
    """Component per id over all pairs (unique ids)."""
    sets = {i: shingle_set(t, k) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for p, a in enumerate(ids):
        for b in ids[p + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def edited(text, rng, share):
    return " ".join(w if rng.random() > share else w + "x" for w in text.split())


def corpus(seed=0):
    rng = random.Random(seed)
    rows = [prose(i, rng.randrange(3, 120)) for i in range(120)]
    shared = prose(999, 60)
    rows += [shared + " " + prose(2000 + i, 200) for i in range(60)]  # a shared passage, not near copies
    base = prose(777, 150)
    rows += [edited(base, rng, 0.01) for _ in range(150)]  # a large group of near copies
    rows += [edited(rows[i], rng, 0.03) for i in range(40)] + rows[:20] + [rows[5].upper(), rows[6].replace(" ", "\n ")]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("k,small,pivot_level,levels", [(4, 64, 2, 5), (5, 3, 1, 2), (4, 5, 2, 3)])
def test_groups_against_all_pairs(spark, k, small, pivot_level, levels):
    rows = corpus(k)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = nd.near_duplicates(docs, words=k, small=small, pivot_level=pivot_level, levels=levels).collect()
    want = brute(rows, k)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_large_nodes_are_compared_in_packs(spark, monkeypatch):
    monkeypatch.setattr(nd, "PACK", 8)
    rows = corpus(9)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = nd.near_duplicates(docs, words=4, small=4, levels=2, pivots=1).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(rows, 4)


def test_estimate_keeps_pairs_above_the_threshold():
    """Random pairs of sets around the threshold: none at or above it is
    refused, most of those well below it are."""
    import numpy as np
    rng = np.random.default_rng(3)

    def bins(x):
        y = np.sort((x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93))
        place, first = np.unique(y >> np.uint64(65 - nd.BINS.bit_length()), return_index=True)
        row = np.zeros(nd.BINS, np.uint8)
        row[place.astype(np.int64)] = ((y[first] >> np.uint64(8)) % np.uint64(255) + np.uint64(1)).astype(np.uint8)
        return row

    refused = kept_low = low = 0
    for _ in range(600):
        n = int(rng.integers(4, 900))
        union = rng.integers(0, 1 << 62, n, dtype=np.uint64)
        both = int(n * rng.uniform(0.5, 1.0))
        cut = both + (n - both) // 2
        a, b = union[:cut], np.r_[union[:both], union[cut:]]
        j = both / n
        x, y = bins(a), bins(b)
        guess, near = nd.estimates(x[None], y[None], np.array([len(a) + len(b)]), 0.8)
        filled = ((x > 0) | (y > 0)).sum()
        assert abs(guess[0] - ((x == y) & (x > 0)).sum() / filled) < 1e-12
        refused += j >= 0.8 and not near[0]
        if j < 0.65:
            low += 1
            kept_low += near[0]
    assert refused == 0 and kept_low < 0.2 * low


def test_edges(edge_docs, clash_docs, empty_docs):
    got = nd.near_duplicates(edge_docs, words=4, carry=("source",))
    rows = got.collect()
    assert len(rows) == len(edge_rows())
    alone = {r["doc_id"]: r for r in rows}
    for i in (1, 2, 3):  # no words: linked with nothing
        assert alone[i]["n_shingles"] == 0 and alone[i]["component_id"] == i and alone[i]["kept"]
    assert alone[9]["component_id"] == 8 and not alone[9]["kept"]
    assert {r["component_id"] for r in rows if r["doc_id"] == 7} == {7}
    assert alone[5]["n_shingles"] == 1  # one word without a space
    null = [r for r in rows if r["doc_id"] is None]
    assert len(null) == 2 and all(r["component_id"] is None and r["kept"] for r in null)
    clash = nd.near_duplicates(clash_docs, words=4, carry=("source",))
    assert sorted_rows(clash) == sorted_rows(got)
    assert nd.near_duplicates(empty_docs).count() == 0


def test_components_against_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 560)]
    edges += [(1000, 1001 + i) for i in range(50)] + [(7, 7)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(edges, "u long, v long"))
    assert sorted_rows(got) == sorted(((x, find(x)) for x in root), key=repr)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_rows_under_repeated_and_null_ids_are_judged_by_their_own_text(spark):
    a, b, c = prose(501, 90), prose(502, 90), prose(503, 90)
    rows = [(5, a), (5, b), (3, b + " more"), (None, c), (None, c + " more"), (None, prose(504, 90)), (8, a + " end"),
            (9, prose(505, 90)), (9, prose(505, 90) + " end"), (None, None)]
    docs = spark.createDataFrame([(i, t, t) for i, t in rows], "doc_id long, text string, what string")
    got = {(r["doc_id"], r["what"]): (r["component_id"], r["kept"]) for r in nd.near_duplicates(
        docs, words=4, carry=("what",)).collect()}
    assert got[5, a] == (5, True) and got[8, rows[6][1]] == (5, False)
    assert got[5, b] == (3, False) and got[3, rows[2][1]] == (3, True)
    assert got[None, rows[5][1]] == (None, True) and got[None, None] == (None, True)
    for x, y in ((rows[3], rows[4]), (rows[7], rows[8])):
        assert got[x][0] == got[y][0] == x[0] and sorted((got[x][1], got[y][1])) == [False, True]

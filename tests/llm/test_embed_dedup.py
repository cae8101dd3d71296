from collections import defaultdict

import numpy as np
import pytest

from tessera.llm import embed_dedup as ed
from tests.llm.conftest import sorted_rows


def brute(ids, vectors, least=0.9):
    ok = [v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    n = defaultdict(int)
    x = {i: np.asarray(v, np.float64) for i, v, o in zip(ids, vectors, ok) if o}
    keys = sorted(x)
    for p, a in enumerate(keys):
        for b in keys[p + 1:]:
            if len(x[a]) == len(x[b]) and x[a] @ x[b] / np.linalg.norm(x[a]) / np.linalg.norm(x[b]) >= least:
                n[a] += 1
                n[b] += 1
                u, v = find(a), find(b)
                root[max(u, v)] = min(u, v)
    return {i: (n[i], find(i)) for i in ids}


def vectors(seed, n=300, d=12):
    rng = np.random.default_rng(seed)
    out = rng.normal(size=(n, d))
    out[50:150] = out[0] + rng.normal(scale=0.25, size=(100, d))  # many near the limit
    out[150:170] = out[200:220] * rng.uniform(0.1, 9, (20, 1))
    out[170:180] = out[1]
    return [[float(np.float32(x)) for x in v] for v in out]


@pytest.mark.parametrize("seed,block_dims,leaf_rows", [(0, 4, 16), (1, 12, 1000), (2, 1, 40), (3, 5, 8)])
def test_links_and_components_against_all_pairs(spark, seed, block_dims, leaf_rows):
    v = vectors(seed)
    table = spark.createDataFrame(list(enumerate(v)), "vec_id long, embedding array<float>")
    got = ed.near_duplicates(table, block_dims=block_dims, leaf_rows=leaf_rows).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == brute(range(len(v)), v)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_leaves_beyond_the_sample_are_divided(spark):
    v = vectors(5)
    table = spark.createDataFrame(list(enumerate(v)), "vec_id long, embedding array<float>")
    got = ed.near_duplicates(table, block_dims=4, leaf_rows=10, sample_rows=32).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == brute(range(len(v)), v)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    v = [None, [], [0.0, 0.0], [1.0, nan], [1.0, None], [inf, 1.0], [1.0, 0.0], [2.0, 0.1], [1.0, 0.0], [-1.0, 0.0],
         [1.0, 0.0, 0.0], [1.0, 0.1, 0.0], [5.0]]
    rows = [(i, x, "extra", 1) for i, x in enumerate(v)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, vec string, id int")
    got = ed.near_duplicates(table)
    want = brute(range(len(v)), v)
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got.collect()} == want
    one = spark.createDataFrame([(None, [1.0, 0.0]), (4, [1.0, 0.0]), (4, [1.0, 0.0])],
                                "vec_id long, embedding array<float>")
    assert sorted_rows(ed.near_duplicates(one), "vec_id", "n_links", "component_id") == sorted(
        [(None, 2, 4), (4, 2, 4), (4, 2, 4)], key=repr)
    assert ed.near_duplicates(table.limit(0)).count() == 0


def answer(spark, rows, **options):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return sorted_rows(ed.near_duplicates(table, **options), "vec_id", "n_links", "component_id", "kept")


def test_rows_of_a_repeated_id_are_judged_by_their_own_vector(spark):
    got = answer(spark, [(5, [1.0, 0.0, 0.0, 0.0]), (5, [0.0, 1.0, 0.0, 0.0]), (3, [1.0, 0.01, 0.0, 0.0])])
    assert got == sorted([(5, 1, 3, False), (5, 0, 5, True), (3, 1, 3, True)], key=repr)


def test_extreme_magnitudes_link_by_direction(spark):
    v = [[1e200, 1e200], [3e200, 3.1e200], [1e-200, 1e-200], [5e-324, 0.0], [1e-310, 1e-312], [-1e300, -1e300], [1.0, 1.0]]
    small = [[x * 1e160 * 1e160 if abs(x) < 1e-150 else x / 1e200 if abs(x) > 1e150 else x for x in w] for w in v]
    want = brute(range(len(v)), small)
    assert {r[0]: r[1:3] for r in answer(spark, list(enumerate(v)))} == want


def test_every_length_is_compared(spark):
    """1,001 lengths, a linked pair in each, more than the sample has rows."""
    rows = [(2 * d + k, [1.0] * d + [0.1 * k]) for d in range(1, 1002) for k in (0, 1)]
    got = answer(spark, rows, sample_rows=100)
    assert all(n == 1 and c == i - i % 2 for i, n, c, _ in got) and len(got) == len(rows)

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, parts=8, size=16, rounds=6):
    kept = [(i, [math.floor(4096 * x) if abs(x) < 1e15 else int(x) * 4096 for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    raw = {id(k): k for k in kept}
    width = -(-max(len(v) for _, v, _ in kept) // parts) * parts
    kept = [(i, v + [0] * (width - len(v)), label) for i, v, label in raw.values()]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:size]
    w = width // parts
    cut = lambda v, p: v[p * w:(p + 1) * w]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(near(p, cut(v, p))[1], []).append(cut(v, p))
            books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k])] if k in groups else e for k, e in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, labels = [], {}
    for i, v, label in kept:
        found = [near(p, cut(v, p)) for p in range(parts)]
        error = sum(d for d, _ in found)
        labels[label] = labels.get(label, 0) + error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, label))
    top = (1 << 63) - 1
    return sorted(((i, c, min(e, top), min(labels[x], top), sha) for i, c, e, x in out), key=repr)


def codes(spark, rows, schema=SCHEMA, **options):
    out = vc.compress(spark.createDataFrame(rows, schema), **options)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("degree", [1, 2, 4, 7])
def test_tree_finds_the_nearest_entry_with_ties(degree):
    rng = np.random.default_rng(degree)
    for trial in range(25):
        n, d = int(rng.integers(1, 60)), int(rng.integers(0, 7))
        far = 3 if trial % 2 else 5000  # small integers give many ties
        entries, q = rng.integers(-far, far, (n, d)), rng.integers(-far, far, (200, d))
        square = ((q[:, None] - entries[None]) ** 2).sum(axis=2)
        tree = vc.Gnat(entries.astype(object), degree)
        for kind in (np.int64, object):
            best, found, computed = tree.nearest(q.astype(kind))
            assert (best == square.argmin(axis=1)).all() and (found == square.min(axis=1)).all()
            assert computed <= 200 * n


def test_whole_subtrees_are_left_out():
    rng = np.random.default_rng(0)
    centres = rng.integers(-50_000, 50_000, (8, 6))
    entries = (centres[:, None] + rng.integers(-20, 20, (8, 32, 6))).reshape(-1, 6)
    q = entries[rng.integers(0, len(entries), 500)] + rng.integers(-5, 5, (500, 6))
    best, found, computed = vc.Gnat(entries.astype(object)).nearest(q)
    assert (found == ((q[:, None] - entries[None]) ** 2).sum(axis=2).min(axis=1)).all()
    assert computed < 0.3 * 500 * len(entries)


def test_roots_are_whole_parts():
    x = np.array([0, 1, 2, 3, 4, 8, 9, 10**14, 10**14 - 1, (1 << 62) - 1, (1 << 31) ** 2 - 1], np.int64)
    want = [math.isqrt(v) for v in x.tolist()]
    assert vc.floor_root(x).tolist() == want and vc.floor_root(x.astype(object)).tolist() == want


def test_limbs_add_up():
    for x in (0, -1, 5, -(1 << 30), 1 << 30, -12345678901234567890123, 1 << 200):
        assert sum(v << (vc.LIMB * k) for k, v in enumerate(vc._limbs(x))) == x


def test_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(24)], rng.choice([None, 1, 2])) for i in rng.sample(range(1000), 150)]
    assert codes(spark, rows) == brute(rows)


def test_ties_and_negative_floors(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1, 0, 1]) / 4096 for _ in range(16)], i % 3) for i in range(120)]
    assert codes(spark, rows) == brute(rows)


EDGES = [(1, None, 1), (2, [], 1), (3, [0.0] * 16, None), (4, [1.5] * 16, None), (4, [1.5] * 16, 2), (5, [None] * 16, 1),
         (6, [float("nan")] * 16, 1), (7, [float("inf")] + [0.0] * 15, 1), (None, [-0.1] * 16, 3), (9, [1.0, 2.0, 3.0], 3),
         (10, [1e200] + [0.0] * 15, 4), (11, [-1e308] * 16, 4), (12, [1e-200] * 16, 4), (13, [0.3] * 21, 5), (14, [3e7, -3e7], 5)]


def test_nulls_lengths_and_extremes(spark):
    assert codes(spark, EDGES) == brute(EDGES)


def test_few_rows_empty_tables_and_clashing_columns(spark):
    assert codes(spark, []) == [] and codes(spark, [(1, None, 1)]) == []
    assert codes(spark, [(5, [1.0] * 8, 1)]) == brute([(5, [1.0] * 8, 1)])
    df = spark.createDataFrame(EDGES, SCHEMA).select("*", *[F.lit(f"x {c}").alias(c) for c in ("id", "vec", "code", "error", "entry")])
    assert sorted((tuple(r) for r in vc.compress(df).collect()), key=repr) == brute(EDGES)

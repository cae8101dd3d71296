import math
import random

from conftest import rows
from tessera.operators.numeric import compensated_sum

# The compensated-sum input vector (FIXTURES.md F9).
F9 = [1.0, 1e100, 1.0, -1e100]


def test_vector_golden_any_partitioning(spark):
    for parts in (1, 2, 3, 4):
        df = spark.createDataFrame([(x,) for x in F9], "x double").repartition(parts)
        assert compensated_sum(df, "x").collect()[0]["total"] == 2.0
    df = spark.createDataFrame([(x,) for x in F9], "x double").coalesce(1)
    assert compensated_sum(df, "x").collect()[0]["total"] == 2.0


def test_grouped_equals_fsum(spark):
    rng = random.Random(1)
    data = [(rng.choice("ABC"), rng.uniform(-1e6, 1e6) * 10 ** rng.randrange(-3, 8)) for _ in range(5000)]
    df = spark.createDataFrame(data, "k string, x double").repartition(7)
    got = dict(rows(compensated_sum(df, "x", ["k"])))
    for k in "ABC":
        assert got[k] == math.fsum(x for kk, x in data if kk == k)


def test_nulls_and_non_finite(spark):
    df = spark.createDataFrame([("a", None), ("a", 1.5), ("b", float("inf")), ("b", 1.0),
                                ("c", float("nan")), ("d", None), (None, 2.0)], "k string, x double")
    got = {r["k"]: r["total"] for r in compensated_sum(df, "x", ["k"]).collect()}
    assert got["a"] == 1.5 and got["b"] == float("inf") and math.isnan(got["c"])
    assert got["d"] is None and got[None] == 2.0 and len(got) == 5


def test_empty_input(spark):
    df = spark.createDataFrame([], "x double")
    assert compensated_sum(df, "x").collect()[0]["total"] is None


def test_many_small_groups_and_mixed_sizes(spark):
    rng = random.Random(5)
    data = []
    for k in range(3000):  # many small groups
        for _ in range(rng.randrange(1, 6)):
            data.append((k, rng.uniform(-1, 1) * 10 ** rng.randrange(-5, 12)))
    for _ in range(500):  # one big group
        data.append((-1, rng.uniform(-1e9, 1e9)))
    data += [(-2, 1.0), (-2, 1e100), (-2, 1.0), (-2, -1e100)]
    df = spark.createDataFrame(data, "k long, x double").repartition(3)
    got = dict(rows(compensated_sum(df, "x", ["k"])))
    exp = {}
    for k, x in data:
        exp.setdefault(k, []).append(x)
    assert len(got) == len(exp)
    for k, xs in exp.items():
        ref = math.fsum(xs)
        assert abs(got[k] - ref) <= 1e-15 * max(1.0, abs(ref)) * 4, (k, got[k], ref)
    assert got[-2] == 2.0


def test_two_keys(spark):
    df = spark.createDataFrame([("a", 1, 0.1), ("a", 1, 0.2), ("a", 2, 0.3), (None, 1, 0.5)],
                               "k1 string, k2 int, x double")
    got = {(r.k1, r.k2): r.total for r in compensated_sum(df, "x", ["k1", "k2"]).collect()}
    assert got == {("a", 1): math.fsum([0.1, 0.2]), ("a", 2): 0.3, (None, 1): 0.5}


def test_small_pending_limit_sends_more_states(spark, monkeypatch):
    from tessera.operators import numeric
    monkeypatch.setattr(numeric, "PENDING", 4)
    rng = random.Random(8)
    data = [(rng.choice("AB"), rng.uniform(-1e8, 1e8)) for _ in range(3000)]
    data += [("C", x) for x in F9] + [("N", None)] + [(f"k{i}", float(i)) for i in range(500)]
    df = spark.createDataFrame(data, "k string, x double").repartition(9)
    got = {r.k: r.total for r in compensated_sum(df, "x", ["k"]).collect()}
    for k in "AB":
        assert got[k] == math.fsum(x for kk, x in data if kk == k)
    assert got["C"] == 2.0 and got["N"] is None
    assert all(got[f"k{i}"] == float(i) for i in range(500)) and len(got) == 504


def test_keys_stay_what_they_are(spark):
    big = 2 ** 53
    df = spark.createDataFrame([(big, 1.0), (big + 1, 10.0), (None, 5.0), (big, 2.0)], "k long, x double").coalesce(1)
    assert {r.k: r.total for r in compensated_sum(df, "x", ["k"]).collect()} == {big: 3.0, big + 1: 10.0, None: 5.0}
    nan = float("nan")
    df = spark.createDataFrame([(nan, 1.0), (None, 2.0), (nan, 4.0), (0.0, 8.0), (-0.0, 16.0)],
                               "k double, x double").repartition(3)
    got = {("nan" if r.k is not None and math.isnan(r.k) else r.k): r.total for r in compensated_sum(df, "x", ["k"]).collect()}
    assert got == {"nan": 5.0, None: 2.0, 0.0: 24.0}


def test_key_types_and_names(spark):
    import datetime as dt
    from decimal import Decimal
    rows_ = [(dt.date(2024, 1, 1), Decimal("1.10"), True, [1, 2], 1.0), (dt.date(2024, 1, 1), Decimal("1.10"), True, [1, 2], 2.0),
             (dt.date(2024, 1, 1), Decimal("1.10"), None, [1, 2], 4.0), (dt.date(2024, 1, 2), Decimal("1.10"), True, None, 8.0)]
    df = spark.createDataFrame(rows_, "hi date, lo decimal(5,2), n boolean, value array<int>, x double")
    got = sorted(r["total"] for r in compensated_sum(df, "x", ["hi", "lo", "n", "value"]).collect())
    assert got == [3.0, 4.0, 8.0]

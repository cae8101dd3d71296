"""Hot keys: one key holds a third (or more) of all rows. AQE's thresholds
are lowered so that local runs take the skew-split join paths; results must
still equal brute force."""

import itertools
import random
from collections import Counter

import pytest

from conftest import rows
from tessera.operators import graph, groups, text

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture()
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_word(skewed):
    rng = random.Random(1)
    lines = [" ".join(["the"] * 5 + [f"w{rng.randrange(300)}" for _ in range(10)]) for _ in range(400)]
    df = skewed.createDataFrame([(v,) for v in lines], "value string").repartition(6)
    exp = Counter(w for v in lines for w in v.split())
    assert dict(rows(text.word_count(df))) == dict(exp)


def test_hot_customer(skewed):
    rng = random.Random(2)
    data = [("hot" if i % 2 else f"c{rng.randrange(50)}", f"o{i // 3}", rng.randrange(1, 9))
            for i in range(3000)]
    df = skewed.createDataFrame(data, "customer string, order_key string, quantity int").repartition(6)
    tot = {}
    for c, o, q in data:
        tot[(c, o)] = tot.get((c, o), 0) + q
    per = {}
    for (c, _), q in tot.items():
        per.setdefault(c, []).append(q)
    exp = {c: sum(v) / len(v) for c, v in per.items() if len(v) > 1}
    got = dict(rows(groups.avg_order_quantity(df)))
    assert got.keys() == exp.keys() and all(abs(got[c] - exp[c]) < 1e-12 for c in exp)


def test_hub_graph(skewed):
    rng = random.Random(3)
    pairs = [(0, k) for k in range(1, 400)]                      # hub: a third and more
    pairs += [(rng.randrange(1, 400), rng.randrange(1, 400)) for _ in range(600)]
    adj = {}
    for a, b in pairs:
        if a != b:
            adj.setdefault(a, set()).add(b)
            adj.setdefault(b, set()).add(a)
    exp = sum(1 for a, b, c in itertools.combinations(sorted(adj), 3)
              if b in adj[a] and c in adj[a] and c in adj[b])
    df = skewed.createDataFrame(pairs, "src long, dst long").repartition(6)
    assert graph.triangle_count(df).collect()[0]["triangles"] == exp
    # Slicing forced on: the hub's pairs are spread over several slices.
    assert graph.triangles(df, slice_pairs=20).count() == exp


def test_wedge_slices_match_plain_pairs(spark):
    from pyspark.sql import functions as F
    from tessera.operators.joins import skew_safe_pairs
    rng = random.Random(4)
    rows_ = [(0, k) for k in range(300)] + [(rng.randrange(1, 30), rng.randrange(1000)) for _ in range(300)]
    a = spark.createDataFrame(rows_, "m long, s long").repartition(5)
    b = a.select("m", F.col("s").alias("e"))
    plain = rows(a.join(b, "m"), "m", "s", "e")
    for bound, pairs in ((10, 50), (1000, 1), (1, 10**9)):
        assert rows(skew_safe_pairs(a, b, "m", "s", bound, pairs), "m", "s", "e") == plain


def test_hot_order_in_rollup(skewed):
    c = skewed.createDataFrame([(i, f"s{i % 3}") for i in range(30)], "ck int, seg string")
    o = skewed.createDataFrame([(0, 0)] + [(i, i % 30) for i in range(1, 200)], "ok int, oc int")
    i = skewed.createDataFrame([(0,)] * 500 + [(k % 200,) for k in range(300)], "io int")
    got = rows(groups.customer_order_item_rollup(c, o, i, "ck", "seg", "ok", "oc", "io"))
    for t, n in (("c", c), ("o", o), ("i", i)):
        n.createOrReplaceTempView(f"sk_{t}")
    naive = rows(skewed.sql("""SELECT seg, count(DISTINCT ck) AS customers, count(DISTINCT ok) AS orders,
                               count(io) AS lines FROM sk_c LEFT JOIN sk_o ON oc = ck
                               LEFT JOIN sk_i ON io = ok GROUP BY seg"""))
    assert got == naive


def test_skew_safe_join_exchanges_both_sides(spark):
    from pyspark.sql import functions as F
    from tessera.operators.joins import skew_safe_join
    big = spark.createDataFrame([(0, i) for i in range(500)] + [(k % 40, k) for k in range(400)] + [(None, 1)],
                                "k int, x int")
    lookup = big.groupBy("k").agg(F.concat(F.lit("n"), F.col("k").cast("string")).alias("name"))
    for how in ("inner", "left"):
        got = skew_safe_join(big, lookup, ["k"], how)
        assert _rows_nulls(got, "k", "x", "name") == _rows_nulls(big.join(lookup, ["k"], how), "k", "x", "name")
        assert got.columns == ["k", "x", "name"]


def test_heavy_key_of_an_aggregated_lookup_is_split(skewed):
    """The executed plan of a lookup join with a hot key shows AQE's split."""
    from pyspark.sql import functions as F
    from tessera.operators.joins import skew_safe_join
    big = skewed.range(60_000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 500).alias("k"),
                                      F.sha2(F.col("id").cast("string"), 256).alias("pad")).repartition(8)
    lookup = skewed.range(2000).groupBy((F.col("id") % 500).alias("k")).agg(F.count(F.lit(1)).alias("c"))
    out = skew_safe_join(big, lookup, ["k"])
    assert out.count() == 60_000
    out.collect()
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()


def test_order_lines_with_a_repeated_order_key(skewed):
    from tessera.plans.inputs import order_lines
    orders = skewed.createDataFrame([(1, 10, "P")] * 300 + [(k, k % 7, "Q") for k in range(2, 200)],
                                    "o_orderkey long, o_custkey long, o_orderpriority string")
    lineitem = skewed.createDataFrame([(k % 200, float(k % 5 + 1)) for k in range(2000)],
                                      "l_orderkey long, l_quantity double")
    got = rows(order_lines(lineitem, orders, ("o_orderpriority",)))
    per = Counter()
    for k in range(2000):
        per[k % 200] += float(k % 5 + 1)
    assert got == sorted([(10, 1, per[1], "P")] * 300 + [(k % 7, k, per[k], "Q") for k in range(2, 200)])


def _rows_nulls(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_rollup_with_hot_keys(skewed):
    c = skewed.createDataFrame([(i, f"s{i % 3}") for i in range(30)] + [(0, "s0")] * 50, "ck int, seg string")
    o = skewed.createDataFrame([(0, 0)] * 200 + [(i, i % 30) for i in range(1, 200)], "ok int, oc int")
    i = skewed.createDataFrame([(0,)] * 500 + [(k % 200,) for k in range(300)], "io int")
    lines, orders = Counter(), Counter()
    for (k,) in [(0,)] * 500 + [(k % 200,) for k in range(300)]:
        lines[k] += 1
    per = Counter()
    for ok, oc in [(0, 0)] * 200 + [(i, i % 30) for i in range(1, 200)]:
        orders[oc] += 1
        per[oc] += lines[ok]
    exp = {}
    for ck, seg in [(i, f"s{i % 3}") for i in range(30)] + [(0, "s0")] * 50:
        e = exp.setdefault(seg, [0, 0, 0])
        e[0] += 1
        e[1] += orders[ck]
        e[2] += per[ck]
    got = rows(groups.customer_order_item_rollup(c, o, i, "ck", "seg", "ok", "oc", "io"))
    assert got == sorted((seg, *e) for seg, e in exp.items())

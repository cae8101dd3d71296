"""Results do not depend on how the input is partitioned."""

from conftest import rows
from tessera.operators import graph, groups, numeric, text

LINES = ["with great data come great", "responsibilities", "a data wall", "wall spring",
         "Humpty", "Dumpty sat on a wall", "Humpty Dumpty had a", "great", "fall semester and spring",
         "", "  ", "a\tb\x0bc"]


def test_text_ops_partition_invariant(spark):
    base = spark.createDataFrame([(v,) for v in LINES], "value string")
    for op in (text.word_count, text.line_length_sum, text.char_pair_counts,
               lambda d: text.char_pair_counts(d, mode="word_ends")):
        ref = rows(op(base.coalesce(1)))
        for n in (2, 5, 11):
            assert rows(op(base.repartition(n))) == ref


def test_group_ops_partition_invariant(spark):
    data = [(f"c{i % 7}", f"o{i % 23}", i % 5 + 1, float(i) * 0.1) for i in range(400)]
    base = spark.createDataFrame(data, "customer string, order_key string, quantity int, x double")
    ops = (groups.avg_order_quantity, groups.order_totals,
           lambda d: numeric.compensated_sum(d, "x", ["customer"]),
           lambda d: groups.retail_key_two_sums(d, "customer", "quantity", "order_key"))
    for op in ops:
        ref = rows(op(base.coalesce(1)))
        for n in (3, 8):
            assert rows(op(base.repartition(n))) == ref


def test_triangles_partition_invariant(spark):
    import random
    rng = random.Random(2)
    pairs = [(rng.randrange(25), rng.randrange(25)) for _ in range(150)]
    base = spark.createDataFrame(pairs, "src long, dst long")
    ref = graph.triangle_count(base.coalesce(1)).collect()[0][0]
    for n in (3, 9):
        assert graph.triangle_count(base.repartition(n)).collect()[0][0] == ref

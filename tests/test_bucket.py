import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.hashing import stable_bucket


def py_bucket(prefix, value, buckets):
    """The rule as stated: SHA-1 over the UTF-8 text of prefix, type and
    value, its 20 bytes read as one number, the remainder by the buckets."""
    text = "|".join([prefix, repr(type(value)), str(value)])
    digest = hashlib.sha1(text.encode()).digest()
    return int.from_bytes(digest, "big") % buckets


def one(spark, value, ddl, dt, n=4):
    df = spark.createDataFrame([(value,)], f"k {ddl}")
    return df.select(stable_bucket(F.col("k"), dt, "abc1234", n).alias("b")).collect()[0]["b"]


def test_documented_examples(spark):
    # The five documented examples (4 buckets).
    assert one(spark, "hi", "string", T.StringType()) == 1
    assert one(spark, "worlds", "string", T.StringType()) == 1
    assert one(spark, 5, "bigint", T.LongType()) == 3
    assert one(spark, "5", "string", T.StringType()) == 2
    st = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType())])
    assert one(spark, ("a", 7), "struct<a:string,b:bigint>", st) == 2


def test_matches_python_and_in_range(spark):
    keys = ["", "it's", 'say "hi"', "both ' and \"", "back\\slash", "héllo", "x" * 300]
    for n in (1, 3, 10, 2**31 - 1):
        for k in keys:
            assert one(spark, k, "string", T.StringType(), n) == py_bucket("abc1234", k, n)
        for k in (0, -5, 2**62):
            assert one(spark, k, "bigint", T.LongType(), n) == py_bucket("abc1234", k, n)
    arr = ["a", "it's"]
    assert one(spark, arr, "array<string>", T.ArrayType(T.StringType()), 97) == py_bucket("abc1234", arr, 97)
    assert one(spark, [1, 2], "array<bigint>", T.ArrayType(T.LongType()), 97) == py_bucket("abc1234", [1, 2], 97)
    assert one(spark, True, "boolean", T.BooleanType(), 97) == py_bucket("abc1234", True, 97)


def test_list_keys_with_non_printable_strings(spark):
    import random
    rng = random.Random(17)
    alphabet = ["a", "Z", " ", "'", '"', "\\", "\t", "\n", "\r", "\x00", "\x1b", "\x7f", "\x85", "\xa0",
                "\xad", "é", "​", " ", "　", "\U0001F600", "\U000E0001", "ß"]
    keys = [[("".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 6)))) for _ in range(2)]
            for _ in range(300)]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k array<string>")
    got = {r.i: r.b for r in df.select("i", stable_bucket(F.col("k"), T.ArrayType(T.StringType()),
                                                          "abc1234", 1000003).alias("b")).collect()}
    for i, k in enumerate(keys):
        assert got[i] == py_bucket("abc1234", k, 1000003), (k, repr(k))


def test_string_keys_any_unicode(spark):
    import random
    rng = random.Random(23)
    pool = [chr(c) for c in list(range(0x20, 0x7f)) + [0xe9, 0x301, 0x4e2d, 0x1f600, 0x10348, 0xa0, 0x2028]]
    keys = ["".join(rng.choice(pool) for _ in range(rng.randrange(0, 30))) for _ in range(400)]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k string")
    got = {r.i: r.b for r in df.select("i", stable_bucket(F.col("k"), T.StringType(), "s@lt|x",
                                                          2**31 - 1).alias("b")).collect()}
    assert all(got[i] == py_bucket("s@lt|x", k, 2**31 - 1) for i, k in enumerate(keys))


ROWS = [("a", None), (None, "a"), (None, None), ("it's", "b")]


def test_nulls_inside_lists(spark):
    n, arr = 1_000_003, T.ArrayType(T.StringType())
    for a, b in ROWS:
        assert one(spark, [a, b], "array<string>", arr, n) == py_bucket("abc1234", [a, b], n)
        st = T.StructType([T.StructField("x", T.StringType()), T.StructField("y", T.StringType())])
        assert one(spark, (a, b), "struct<x:string,y:string>", st, n) == py_bucket("abc1234", [a, b], n)
    nested = T.ArrayType(T.ArrayType(T.LongType()))
    for v in ([[1, None], None], [None], [[], [None]]):
        assert one(spark, v, "array<array<bigint>>", nested, n) == py_bucket("abc1234", v, n)
    assert one(spark, [True, None, False], "array<boolean>", T.ArrayType(T.BooleanType()), n) == py_bucket(
        "abc1234", [True, None, False], n)


@pytest.mark.parametrize("ddl,dt", [("string", T.StringType()), ("bigint", T.LongType()), ("boolean", T.BooleanType()),
                                    ("array<string>", T.ArrayType(T.StringType())),
                                    ("struct<x:string>", T.StructType([T.StructField("x", T.StringType())]))])
def test_a_null_key_has_no_bucket(spark, ddl, dt):
    assert one(spark, None, ddl, dt) is None

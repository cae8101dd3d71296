import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])
# Names the operators use for columns of their own.
CLASHES = ("size", "shard", "old_shard", "block", "key", "row", "base", "tokens", "score", "position", "n_words", "id",
           "node", "start", "piece", "length", "lang_pred", "hash", "predicted", "failed_bits", "_row", "_bucket", "_h",
           "slot", "taken", "target", "vec", "digest", "rep")
WORDS = "the of and to in it is was for on are with they be at this from have or by one had not but what".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ing", "ed", str(rng.randrange(9))]) for _ in range(n))


def edge_rows():
    """Nulls in every column, empty, blank and very long texts, one text
    without a space, repeated rows, copies and repeated ids."""
    long_text = prose(1, 30_000)
    rows = [(1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n ", None, None, 4), (4, long_text, "en", "a", 1),
            (5, "x" * 20_000, "en", "b", 1), (None, prose(2, 60), "en", None, 1), (7, "one", "de", "b", 3),
            (7, "one", "de", "b", 3), (7, "two words", "de", "b", 9), (8, prose(3, 200), "fr", "c", 1),
            (9, prose(3, 200), "fr", "c", 1), (10, "日本 語 ▁ ünï x\x00y <s> <|endoftext|>", "ja", "c", 1),
            (None, None, None, None, None)]
    rows += [(11, prose(4, 80), "en", "a", 1)] * 3
    rows += [(100 + i, prose(100 + i, 40 + i), "en" if i % 2 else "de", "abc"[i % 3], 1) for i in range(30)]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def clash_docs(spark, edge_docs):
    """The same rows with extra columns called like the operators' own."""
    from pyspark.sql import functions as F
    return edge_docs.select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def sorted_rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)

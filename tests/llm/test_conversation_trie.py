import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.llm.conversation_trie import conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """Node rows by sets of prefixes; turns of equal number must be equal."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - c % 20, [])[:h] + mine[h:])
    members = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    out = []
    for p, m in members.items():
        below = [q for q in members if q[:len(p)] == p]
        parents = {q[:-1] for q in members if q}
        ends = sorted(c for c in m if len(built[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), sum(q[:-1] == p for q in below if q),
                    sum(q not in parents for q in below),
                    sum((len(members[q]) - 1) * len(WORD.findall(q[-1][1])) for q in below if q),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def random_rows(seed, convs, longest, texts=3):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(200), convs):
        for t in range(rng.randrange(1, longest)):
            rows.append((c, t, rng.choice(["user", "assistant"]) if rng.random() < 0.2 else "user",
                         " ".join("w" for _ in range(rng.randrange(texts)))))
    rng.shuffle(rows)
    return rows


def nodes(spark, rows, **options):
    out = conversation_trie(spark.createDataFrame(rows, SCHEMA), **options)
    assert out.columns == COLUMNS
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("seed, convs, longest, options", [
    (2, 80, 7, {"chunk": 16}), (3, 40, 8, {"band": 3, "chunk": 9}), (4, 50, 4, {"band": 1, "chunk": 1})])
def test_against_brute_force(spark, seed, convs, longest, options):
    rows = random_rows(seed, convs, longest)
    assert nodes(spark, rows, **options) == brute(rows)


def test_copies_of_one_conversation_and_one_long_one(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 2000, 20) for t in range(5)]
    rows += [(7, t, "user", f"turn {t % 3}") for t in range(700)]
    assert nodes(spark, rows, chunk=64) == brute(rows)


EDGES = [(20, None, "user", "null first"), (20, 0, "user", "a b"), (20, 5, None, None), (21, 0, "user", "x"), (22, 3, "", ""),
         (23, 0, "u", "a" * 50_000), (23, 1, "u", " \t\n "), (45, 0, "user", "alone"), (None, 0, "user", "no id"), (-3, 0, "u", "neg"),
         (24, 0, "user", "same"), (24, 0, "user", "same"), (1 << 40, 0, "u", "日本 語 <s>")]


def test_nulls_blank_long_texts_and_repeated_turns(spark):
    assert nodes(spark, EDGES) == brute(EDGES)


def test_base_absent_or_shorter_than_what_is_taken(spark):
    rows = [(c, t, "user", f"{c} {t}") for c in range(40, 60) if c != 40 for t in range(c % 3 + 1)]
    rows += [(60, 0, "user", "only one")] + [(c, 0, "user", f"own {c}") for c in range(61, 80)]
    got = nodes(spark, rows)
    assert got == brute(rows) and any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in got)  # turnless ones end at the root


def test_empty_table_and_clashing_columns(spark):
    assert nodes(spark, []) == []
    names = ("pos", "digest", "words", "id", "band", "ids", "r1", "e1", "key", "parent", "depth", "members", "least", "last", "own", "h")
    df = spark.createDataFrame(EDGES, SCHEMA).select("*", *[F.lit(f"extra {c}").alias(c) for c in names])
    assert sorted((tuple(r) for r in conversation_trie(df).collect()), key=repr) == brute(EDGES)

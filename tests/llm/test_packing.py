import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from tessera.llm import packing as pk  # noqa: E402
from tests.llm.conftest import edge_rows, prose, sorted_rows  # noqa: E402

NAME, END = "byte_bpe_50k.json", 2


def used(groups, capacity):
    out = defaultdict(int)
    for content, times in groups:
        assert times > 0 and sum(length * per for length, per in content) <= capacity
        for length, per in content:
            out[length] += per * times
    return dict(out)


@pytest.mark.parametrize("seed", range(12))
def test_plans_hold_exactly_the_histogram(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 32, 64])
    h = {rng.randrange(1, capacity + 1): rng.randrange(1, 400) for _ in range(rng.randrange(1, 25))}
    groups = pk.plan(h, capacity)
    assert used(groups, capacity) == h and used(pk.best_fit(h, capacity), capacity) == h
    least = -(-sum(k * n for k, n in h.items()) // capacity)
    assert least <= sum(n for _, n in groups)


def test_patterns_fill_the_capacity():
    got = {tuple(p) for p in pk.patterns_of(range(1, 13), 12).tolist()}
    want = {(a, b, c) for a in range(1, 13) for b in range(a + 1) for c in range(b + 1)
            if a + b + c == 12 and not (b == 0 and c)}
    assert got == want


def test_fit_is_the_non_negative_least_squares_solution():
    import numpy as np
    rng = np.random.default_rng(1)
    h = rng.integers(0, 50, 25)
    h[0] = 0
    patterns = pk.patterns_of(np.flatnonzero(h), 24)
    x = pk.fit_counts(patterns, h, rounds=500, tolerance=1e-9)
    a = np.zeros((25, len(patterns)))
    for j in range(3):
        np.add.at(a, (patterns[:, j], np.arange(len(patterns))), 1.0)
    a[0] = 0
    gradient = a.T @ (h - a @ x)
    assert x.min() >= 0 and gradient.max() < 1e-2 and abs(gradient[x > 1e-6]).max() < 1e-2


def test_dense_histograms_come_within_a_thousandth():
    rng = random.Random(2)
    h = defaultdict(int)
    for _ in range(60_000):
        h[min(256, max(1, int(rng.lognormvariate(4.6, 0.9))))] += 1
    groups = pk.plan(h, 256)
    least = -(-sum(k * n for k, n in h.items()) // 256)
    assert used(groups, 256) == dict(h)
    assert sum(n for _, n in groups) <= least * 1.002
    assert sum(n for _, n in groups) <= sum(n for _, n in pk.best_fit(h, 256))


def check(docs, rows, capacity):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path(NAME))
    packed = pk.pack(docs, NAME, END, capacity, with_ids=True)
    got = packed.collect()
    by_doc, places = defaultdict(list), defaultdict(list)
    for r in got:
        assert 1 <= r["length"] <= capacity and len(r["ids"]) == r["length"]
        raw = b"".join(i.to_bytes(4, "little") for i in r["ids"])
        assert r["ids_crc32"] == zlib.crc32(raw)
        by_doc[r["doc_id"]].append((r["piece"], r["start"], tuple(r["ids"])))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for spots in places.values():  # gapless, within the capacity
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= capacity
    want = defaultdict(list)
    for i, text, *_ in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [END]
        cuts = [0, *range(len(ids) % capacity or capacity, len(ids), capacity)] if len(ids) > capacity else [0]
        want[i] += [(k, a, tuple(ids[a:b])) for k, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(ids)]))]
    assert {k: sorted(v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in want.items()}
    total = sum(r["length"] for r in got)
    assert sum(len(r["ids"]) for r in pk.sequences(packed).collect()) == total
    return len(places), -(-total // capacity)


def test_edges(edge_docs, empty_docs):
    check(edge_docs, edge_rows(), 64)
    assert pk.pack(empty_docs, NAME).count() == 0


def test_clashing_columns(edge_docs, clash_docs):
    a, b = pk.pack(edge_docs, NAME), pk.pack(clash_docs, NAME)
    assert a.columns == b.columns and sorted_rows(a.drop("sequence_id", "offset")) == sorted_rows(
        b.drop("sequence_id", "offset"))


def test_few_sequences(spark):
    rows = [(i, prose(i, 5 + i * 13 % 150)) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    n, least = check(docs, rows, 128)
    assert n <= least * 1.01


@pytest.mark.parametrize("seed", range(6))
def test_plans_never_need_more_than_best_fit(seed):
    """Sparse histograms, where rounded patterns strand their partners."""
    rng = random.Random(seed)
    lengths = rng.sample(range(1, 1025), 40 if seed % 2 else 400)
    h = {x: rng.choice([1, 1, 2, 5, 60 if seed < 3 else 3]) for x in lengths}
    groups = pk.plan(h, 1024)
    held = {}
    for content, times in groups:
        assert sum(x * k for x, k in content) <= 1024
        for x, k in content:
            held[x] = held.get(x, 0) + k * times
    total, best = (sum(t for _, t in g) for g in (groups, pk.best_fit(h, 1024)))
    assert held == h and total <= best


def test_patterns_stay_where_they_cost_nothing():
    h = {600: 500, 424: 500, 300: 200, 724: 200}
    assert sum(t for _, t in pk.plan(h, 1024)) == 700
    assert pk.plan({}, 1024) == []


def test_words_with_marks_and_parts_of_long_texts():
    from tessera.llm.common import tokenizer_path
    from tessera.llm.segments import HfSegments
    from tokenizers import Tokenizer
    enc, t = HfSegments(tokenizer_path(NAME), 1000), Tokenizer.from_file(tokenizer_path(NAME))
    rng = random.Random(5)
    bits = ["word", "été", "a", "x1", "don't", "...", "!!", ".,", "$$$", "'s", "<s>", "<|endoftext|>", "日本", "ß", "²", "Ünï"]
    texts = [" ".join("".join(rng.choice(bits) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(1, 40)))
             for _ in range(300)] + [None, "", " lead", "two  spaces", "tab\tin", "end ", "one"]
    want = [np.asarray(t.encode(x or "", add_special_tokens=False).ids, "<u4").tobytes() for x in texts]
    for most in (1 << 22, 50, 1):
        assert enc.id_bytes(texts, most) == want


def test_words_of_letters_and_words_over_a_line_end():
    from tessera.llm.common import tokenizer_path
    from tessera.llm.segments import HfSegments
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path(NAME))
    rng = random.Random(6)
    letters = [chr(c) for c in [*range(65, 91), *range(97, 123), *range(0xaa, 0x100), 0x100, 0x3b1, 0x4e2d]]
    words = ["".join(rng.choices(letters, k=rng.randrange(1, 12))) + rng.choice(["", "", ".", "?!", "\n", ".\n", "\n\n", ",\r\n"])
             for _ in range(3000)]
    texts = [" ".join(words), "".join(words)] + [" ".join(w + v for w, v in zip(words[i::7], words[i + 1::7])) for i in range(7)]
    texts += [f"a{chr(c)}b {chr(c)} c" for c in range(0x2100) if not 0xd800 <= c < 0xe000]
    want = [np.asarray(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]
    enc = HfSegments(tokenizer_path(NAME), 1000)
    assert enc.letters is not None and enc.parts_lines
    assert enc.id_bytes(texts) == want and enc.id_bytes(texts) == want
    enc.letters = None  # as for a tokenizer whose pre-tokenizer changes letters
    enc.cache, enc.firsts = type(enc.cache)(1000), type(enc.firsts)(1000)
    assert enc.id_bytes(texts) == want


def test_words_of_letters_need_neither_cache_nor_an_object_each():
    from tessera.llm.common import tokenizer_path
    from tessera.llm.segments import HfSegments
    from tokenizers import Tokenizer
    enc, t = HfSegments(tokenizer_path(NAME), 1000), Tokenizer.from_file(tokenizer_path(NAME))
    rng = random.Random(8)
    letters = [chr(c) for c in [*range(65, 91), *range(97, 123), *range(0xc0, 0x100)] if c not in (0xd7, 0xf7)]
    words = ["".join(rng.choices(letters[:52] if i % 2 else letters, k=rng.randrange(1, 9))) for i in range(20_000)]
    marked = [w + rng.choice(["", ",", ".\nThe", "?!\né|", "\nÀ"]) for w in words]
    texts = [" ".join(marked[i:i + 500]) for i in range(0, len(marked), 500)]
    texts += ["  ".join(words[:300]), " " + " ".join(words[300:600]), None, "x", "a b", "é", "two  spaces 1.5 é,è"]
    want = [np.asarray(t.encode(x or "", add_special_tokens=False).ids, "<u4").tobytes() for x in texts]
    looked_up, filled = [], enc._filled
    enc._filled = lambda cache, keys, encode: looked_up.extend(keys) or filled(cache, keys, encode)
    for most in (1 << 22, 3000, 1 << 22):
        assert enc.id_bytes(texts, most) == want
    assert enc.id_bytes([]) == [] and enc.id_bytes([None, ""]) == [b"", b""]
    assert len(enc.cache.young) < 2000 and not enc.cache.old
    looked_up.clear()
    assert enc.id_bytes(texts[:40]) == want[:40] and len(looked_up) < 200

import random

import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from tessera.llm import token_counts as tc  # noqa: E402
from tessera.llm.common import TwoTierCache  # noqa: E402
from tests.llm.conftest import edge_rows, sorted_rows  # noqa: E402

PIECE, BYTE = "piece_bpe_32k.model", "byte_bpe_50k.json"


def texts():
    rng = random.Random(5)
    alphabet = ["a", "b", " ", "  ", "\n", "\t", "▁", "é", "日", "0", ".", "<s>", " ", "\x1c", "'ll", "<|endoftext|>"]
    some = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(12))) for _ in range(600)]
    return some + [r[1] for r in edge_rows() if r[1] is not None]


def test_sentencepiece_counts_equal_whole_text_encoding():
    c = tc.SentencePieceCounter(public_tokenizers.path(PIECE), 4 << 10, 50)
    assert c.safe
    some = texts()
    assert c.counts(some) == [len(x) for x in c.model.encode(some)]
    assert c.counts(some) == c.counts(some)


def test_hf_segments_equal_whole_text_encoding():
    import numpy as np
    from tessera.llm.segments import HfSegments
    h = HfSegments(public_tokenizers.path(BYTE), 50)
    assert h.safe
    for t, got in zip(texts(), h.id_bytes(texts())):
        want = h.tokenizer.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(got, "<u4").tolist() == want


def test_an_unsafe_tokenizer_gets_whole_texts():
    from tessera.llm.segments import HfSegments
    h = HfSegments(public_tokenizers.path("word_bpe_49k.json"), 50)
    some = ["Hello there  you", "", "a b"]
    assert [len(x) // 4 for x in h.id_bytes(some)] == [
        len(h.tokenizer.encode(t, add_special_tokens=False).ids) for t in some]


def test_byte_batches_and_slices():
    assert list(tc.byte_batches(["aa", "é", "b" * 9, "c"], 4)) == [["aa", "é"], ["b" * 9], ["c"]]
    assert list(tc.slices_by_bytes([3, 3, 9, 1, 1], 6)) == [(0, 2), (2, 3), (3, 5)]
    assert list(tc.slices_by_bytes([], 6)) == []


def test_cache_is_bounded_and_keeps_used_entries():
    c = TwoTierCache(3)
    for i in range(20):
        c.put(i, i)
        c.put("hot", 1) if c.lookup("hot") is None else None
    assert len(c.young) + len(c.old) <= 6 and c.lookup("hot") == 1


@pytest.mark.parametrize("name", [PIECE, BYTE])
def test_edges(edge_docs, clash_docs, empty_docs, name):
    got = tc.token_counts(edge_docs, name, limit=100)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    rows = sorted_rows(got)
    assert len(rows) == len(edge_rows()) and rows == sorted_rows(tc.token_counts(clash_docs, name, limit=100))
    assert (1, 0, 0, False) in rows and (2, 0, 0, False) in rows
    assert all(r[3] == (r[2] > 100) for r in rows)
    assert tc.token_counts(empty_docs, name).count() == 0


def test_no_shuffle(edge_docs):
    plan = tc.token_counts(edge_docs, PIECE)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert tc.token_counts(edge_docs, PIECE).filter(F.col("n_tokens") < 0).count() == 0

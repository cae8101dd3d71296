"""Token counts of whole texts (operator 10): batch encoding in Arrow
functions that return lengths only.

A text is cut at *safe boundaries*, places no token can span. For a
sentencepiece model these are the starts of runs of spaces: the model marks
a space with U+2581, and no piece of the vocabulary has that mark after
another character (checked when the model is loaded; a model that breaks it
is encoded text by text). The distinct segments not yet known are
encoded in batches balanced by bytes, and only their lengths are kept, in a
bounded cache per worker. For a ``tokenizers`` file the segments come from
:mod:`tessera.llm.segments`.

Defined results: null and empty text have 0 bytes and 0 tokens; a text
without a safe boundary is one segment; repeated rows are counted each;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import ship_package

from tessera.llm.common import TwoTierCache, tokenizer_path, utf8_bytes, worker_state
from tessera.llm.segments import HfSegments

# Fixed value: sentencepiece's mark for a space.
MARK = "▁"


def byte_batches(items: Iterable[str], limit: int) -> Iterator[list[str]]:
    """Lists of items of at most ``limit`` UTF-8 bytes in all (a longer item
    is a list of its own)."""
    batch: list[str] = []
    size = 0
    for s in items:
        n = len(s.encode("utf-8", "surrogatepass"))
        if batch and size + n > limit:
            yield batch
            batch, size = [], 0
        batch.append(s)
        size += n
    if batch:
        yield batch


class SentencePieceCounter:
    """Token counts under a sentencepiece model. Segments are spelled
    without their first space mark, as encoding puts one in front."""

    def __init__(self, path: str, batch_bytes: int, cache_size: int):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.batch_bytes = batch_bytes
        self.cache = TwoTierCache(cache_size)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        probe = self.model.encode(["a b", " a", "a  b"], out_type=str)
        keeps_spaces = probe == [[MARK + "a", MARK + "b"], [MARK, MARK + "a"], [MARK + "a", MARK, MARK + "b"]]
        self.safe = keeps_spaces and not any(MARK in p.lstrip(MARK) for p in pieces)

        self.starts = [p.startswith(MARK) for p in pieces]

    def _encode(self, segments: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode(segments, num_threads=1)]

    def _encode_words(self, words: list[str]) -> list[int]:
        """Lengths of segments without a space, encoded as one text: every
        piece with a space mark starts the next segment."""
        import numpy as np
        ids = np.asarray(self.model.encode(" ".join(words), num_threads=1))
        at = np.flatnonzero(np.asarray(self.starts)[ids])
        if len(at) != len(words):
            raise AssertionError("segments and space marks differ")
        return np.diff(np.append(at, len(ids))).tolist()

    @staticmethod
    def segments(text: str) -> list[str]:
        """Segments of a text: a run of spaces with the characters up to the
        next run, the first space left out (the dummy prefix stands for it).
        A run of k spaces at the end is spelled by k - 1 spaces; a single one
        is the mark itself."""
        parts = text.split(" ")
        if "" not in parts:
            return parts
        out, spaces = [], 0
        for i, p in enumerate(parts):
            if p:
                out.append(" " * spaces + p)
                spaces = 0
            elif i < len(parts) - 1:
                spaces += 1
        if not parts[-1]:
            out.append(" " * spaces if spaces else MARK)
        return out

    def counts(self, texts: list[str | None]) -> list[int]:
        if not self.safe:
            return [n for b in byte_batches([t or "" for t in texts], self.batch_bytes) for n in self._encode(b)]
        cut = [self.segments(t.replace(MARK, " ")) if t else [] for t in texts]
        cache, known = self.cache, {MARK: 1}
        for segs in cut:
            missing = [s for s in set(segs) if s not in known]
            for s in missing:
                known[s] = cache.lookup(s)
        todo = [s for s, n in known.items() if n is None]
        words = [s for s in todo if " " not in s]
        rest = [s for s in todo if " " in s]
        for some, encode in ((words, self._encode_words), (rest, self._encode)):
            for batch in byte_batches(some, self.batch_bytes):
                for s, n in zip(batch, encode(batch)):
                    known[s] = n
                    if len(s) <= 64:
                        cache.put(s, n)
        get = known.__getitem__
        return [sum(map(get, segs)) for segs in cut]


class HfCounter:
    """Token counts under a ``tokenizers`` file."""

    def __init__(self, path: str, batch_bytes: int, cache_size: int):
        self.segments = HfSegments(path, cache_size)

    def counts(self, texts: list[str | None]) -> list[int]:
        return [len(x) // 4 for x in self.segments.id_bytes(texts)]


def _counter(path: str, batch_bytes: int, cache_size: int):
    kind = SentencePieceCounter if path.endswith(".model") else HfCounter
    return kind(path, batch_bytes, cache_size)


def slices_by_bytes(lengths: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (at least one row each)."""
    start = size = 0
    for i, n in enumerate(lengths):
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(lengths):
        yield start, len(lengths)


def token_counts(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id",
                 limit: int = 4096, batch_bytes: int = 4 << 20, cache_size: int = 300_000) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) per row of ``docs``; the text
    column never leaves the map stage, which has no shuffle."""
    ship_package()
    key_type = docs.schema[key].dataType
    schema = T.StructType([T.StructField(key, key_type), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])

    def run(batches):
        import pyarrow as pa
        path = tokenizer_path(tokenizer)
        counter = worker_state(("count", path, batch_bytes, cache_size),
                               lambda: _counter(path, batch_bytes, cache_size))
        for b in batches:
            sizes = b.column("n_bytes").to_pylist()
            texts = b.column("text")
            n: list[int] = []
            for lo, hi in slices_by_bytes(sizes, batch_bytes):
                n += counter.counts(texts.slice(lo, hi - lo).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(key), b.column("n_bytes"), pa.array(n, pa.int64())], names=[key, "n_bytes", "n_tokens"])

    rows = docs.select(F.col(key), utf8_bytes(text).alias("n_bytes"), F.col(text).alias("text"))
    return (rows.mapInArrow(run, schema)
            .withColumn("over_limit", F.col("n_tokens") > F.lit(limit)))

"""Language identification by prediction by partial matching (operator 5).

Each language has a variable-order context tree over UTF-8 bytes (of the
lower-cased text): at a context of ``order`` bytes the next byte costs
-log2(c / (T + D)) bits if it was seen there c times, with T bytes and D
different ones seen in that context; else an escape, -log2(D / (T + D)),
and the next shorter context tries (PPM with escape method C, without
exclusions); below the empty context a byte costs 8 bits. The statistics
are frozen after training, so a text's code length under a language is an
exact sum over its bytes, and the language with the shortest code wins.

Trees are learned from a bounded sample: at most ``docs_per_lang`` learning
rows per language, of at most ``max_chars`` characters each; where a language
has too few rows that short, the first ``max_chars`` characters of longer ones
fill up. All scored texts are scored whole, in pieces of bytes that carry
their context along, so the work space is that of a piece. The trees of all languages are merged
into one table per order: n-gram -> code length per language, so one lookup
serves all languages.

Defined results: a null text, or one without a letter, is ``und`` with score
0; so is everything if no row can be learned from. The score is the share of
the winner when languages are weighted by 2^-(bits). Equal code lengths go
to the language that sorts first. Repeated rows get equal results; extra
columns are kept, those called like an output replaced; an empty table gives
an empty result; very long texts need their own bytes twice and a piece's
work space.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import give_back_memory, packed, share, unpacked
from tessera.llm.token_counts import slices_by_bytes

UNKNOWN = "und"
ORDER = 4
PAD = 10  # the byte that fills the context before a text


def sample_per_class(rows: DataFrame, label: str, key: str, cap: int) -> DataFrame:
    """At most ``cap`` rows per label, the first by a hash of (key, text):
    labels are counted (combined map-side), a hash threshold keeps about
    twice the cap of each, and the final cut ranks only those."""
    name = F.to_json(F.struct(label))  # labels may be structs
    counts = {r[0]: r[1] for r in rows.groupBy(name).count().collect()}  # one row per label
    if not counts:
        return rows.limit(0)
    h = F.pmod(F.xxhash64(F.col(key).cast("string"), F.col("text")), F.lit(1 << 30))
    share = F.create_map(*[x for k, n in counts.items() for x in
                           (F.lit(k), F.lit(min(1.0, (2 * cap + 20) / n) * (1 << 30)))])
    some = rows.withColumn("_h", h).filter(F.col("_h") < share[name])
    rank = F.row_number().over(Window.partitionBy(label).orderBy("_h", key, "text"))
    return some.withColumn("_r", rank).filter(F.col("_r") <= cap).drop("_h", "_r")


class HashedKeys:
    """Positions of 64-bit keys by multiplicative hashing, vectorised: keys
    that lose their slot go to a next table with another multiplier."""

    MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                   0xA0761D6478BD642F, 0xE7037ED1A0B428DB)

    def __init__(self, keys):
        import numpy as np
        self.tables, self.rest = [], (np.empty(0, np.uint64), np.empty(0, np.int32))
        left, index = keys.astype(np.uint64), np.arange(len(keys), dtype=np.int32)
        for m in self.MULTIPLIERS:
            if not len(left):
                break
            bits = max(4, int(len(left) * 3).bit_length())
            slot = (left * np.uint64(m)) >> np.uint64(64 - bits)
            slots = np.full(1 << bits, -1, np.int32)
            slots[slot] = np.arange(len(left), dtype=np.int32)
            won = slots[slot] == np.arange(len(left), dtype=np.int32)
            at_key = np.zeros(1 << bits, np.uint64)
            at_index = np.full(1 << bits, -1, np.int32)
            at_key[slot[won]], at_index[slot[won]] = left[won], index[won]
            self.tables.append((np.uint64(m), np.uint64(64 - bits), at_key, at_index))
            left, index = left[~won], index[~won]
        if len(left):  # practically never: a sorted remainder
            order = np.argsort(left)
            self.rest = (left[order], index[order])

    def find(self, keys):
        """Index of each key, -1 where absent."""
        import numpy as np
        out = np.full(len(keys), -1, np.int32)
        todo = None
        for m, shift, at_key, at_index in self.tables:
            k = keys if todo is None else keys[todo]
            slot = (k * m) >> shift
            hit = np.where(at_key[slot] == k, at_index[slot], -1)
            if todo is None:
                out = hit.astype(np.int32)
                todo = np.flatnonzero(out < 0)
            else:
                out[todo] = hit
                todo = todo[hit < 0]
            if not len(todo):
                return out
        rest, index = self.rest
        if len(rest) and todo is not None and len(todo):
            at = np.minimum(np.searchsorted(rest, keys[todo]), len(rest) - 1)
            out[todo] = np.where(rest[at] == keys[todo], index[at], -1)
        return out


def grams(data, k: int):
    """(k+1)-byte windows ending at each byte from position ORDER on."""
    import numpy as np
    n = len(data) - ORDER
    key = np.zeros(n, np.uint64)
    for j in range(ORDER - k, ORDER + 1):
        key = (key << np.uint64(8)) | data[j:j + n].astype(np.uint64)
    return key


class PpmModel:
    """Merged context trees of several languages."""

    def __init__(self, languages: list[str], levels: list[dict]):
        self.languages, self.levels = languages, levels

    @classmethod
    def train(cls, texts: dict[str, list[str]]) -> "PpmModel":
        import numpy as np
        languages = sorted(texts)
        count = len(languages)
        pad = bytes([PAD]) * ORDER
        data = [np.frombuffer(pad + pad.join(t.lower().encode("utf-8", "replace") for t in texts[lang]) + pad,
                              np.uint8) for lang in languages]
        levels: list[dict] = []
        below = None  # full code lengths of the level below, and its keys
        for k in range(ORDER + 1):
            seen = [np.unique(grams(d, k), return_counts=True) for d in data]
            keys = np.unique(np.concatenate([s[0] for s in seen]))
            contexts = np.unique(keys >> np.uint64(8))
            escape = np.zeros((len(contexts), count), np.float64)
            cost = np.zeros((len(keys), count), np.float64)
            for i, (mine, c) in enumerate(seen):
                at = np.searchsorted(contexts, mine >> np.uint64(8))
                total = np.bincount(at, c, len(contexts))
                different = np.bincount(at, minlength=len(contexts))
                known = different > 0
                escape[known, i] = np.log2((total[known] + different[known]) / different[known])
                shorter = (np.full(len(keys), 8.0) if below is None else
                           below[1][np.searchsorted(below[0], keys & np.uint64((1 << (8 * k)) - 1)), i])
                cost[:, i] = escape[np.searchsorted(contexts, keys >> np.uint64(8)), i] + shorter
                cost[np.searchsorted(keys, mine), i] = np.log2((total[at] + different[at]) / c)
            below = (keys, cost)
            levels.append({"keys": HashedKeys(keys), "cost": cost.astype(np.float32),
                           "contexts": HashedKeys(contexts), "escape": escape.astype(np.float32)})
        return cls(languages, levels)

    def bits(self, data):
        """Code length per byte (after the first ORDER) and language."""
        import numpy as np
        top = self.levels[ORDER]
        key = grams(data, ORDER)
        at = top["keys"].find(key)
        out = top["cost"][at]
        miss = np.flatnonzero(at < 0)
        if len(miss):
            out[miss] = 0.0
        k = ORDER
        while len(miss):
            level, key = self.levels[k], key[miss] if k == ORDER else key
            context = level["contexts"].find(key >> np.uint64(8)) if k else np.zeros(len(key), np.int32)
            known = context >= 0
            out[miss[known]] += level["escape"][context[known]]
            if k == 0:
                out[miss] += 8.0
                break
            k -= 1
            key = key & np.uint64((1 << (8 * (k + 1))) - 1)
            at = self.levels[k]["keys"].find(key)
            found = at >= 0
            out[miss[found]] += self.levels[k]["cost"][at[found]]
            miss, key = miss[~found], key[~found]
        return out

    def code_lengths(self, texts: list[str | None], piece: int = 1 << 18):
        """Bits per text and language, over whole texts, in pieces of bytes
        that start with the context before them."""
        import numpy as np
        out = np.zeros((len(texts), len(self.languages)))
        piece = max(piece, ORDER)
        pad = bytes([PAD]) * ORDER
        parts: list[bytes] = []  # each with the ORDER bytes before it, in all about a piece
        of: list[int] = []
        size = 0

        def flush():
            data = np.frombuffer(b"".join(parts), np.uint8)
            sizes = np.array([len(x) for x in parts], np.int64)
            start = np.cumsum(sizes) - sizes
            cost = self.bits(data)  # per byte from ORDER on; those that look back over a part's start do not count
            inside = np.arange(len(cost)) < np.repeat(start + sizes - ORDER, sizes)[:len(cost)]
            cost[~inside] = 0.0
            np.add.at(out, np.array(of), np.add.reduceat(cost, start, axis=0, dtype=np.float64))

        for i, t in enumerate(texts):
            raw = (t or "").lower().encode("utf-8", "replace")
            for at in range(0, len(raw), piece):
                part = (raw[at - ORDER:at] if at else pad) + raw[at:at + piece]
                if parts and size + len(part) > piece:
                    flush()
                    parts, of, size = [], [], 0
                parts.append(part)
                of.append(i)
                size += len(part)
        if parts:
            flush()
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        import numpy as np
        bits = self.code_lengths(texts)
        best = bits.argmin(axis=1)
        margin = np.minimum(bits - bits.min(axis=1, keepdims=True), 1000.0)
        return [self.languages[i] for i in best], (1.0 / np.exp2(-margin).sum(axis=1)).tolist()


def train(learn: DataFrame, key: str = "doc_id", docs_per_lang: int = 200, max_chars: int = 20_000) -> PpmModel | None:
    """A model from the rows of ``learn`` (key, text, lang), or None if no
    row has both. Only the bounded sample reaches the driver."""
    rows = learn.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    long_ = F.length("text") > max_chars
    rows = rows.select(F.col(key).alias("doc_id"), "text", F.struct("lang", long_.alias("long")).alias("kind"))
    # Short rows of a language first, heads of long ones where those are too few.
    found = [(r["lang"], r["long"], r["head"]) for r in sample_per_class(rows, "kind", "doc_id", docs_per_lang).select(
        "kind.*", F.substring("text", 1, max_chars).alias("head")).collect()]
    texts: dict[str, list[str]] = {}
    for lang, _, head in sorted(found):
        if len(texts.setdefault(lang, [])) < docs_per_lang:
            texts[lang].append(head)
    return PpmModel.train({k: sorted(v) for k, v in texts.items()}) if texts else None


def identified(docs: DataFrame, model: PpmModel | None, text: str = "text",
               batch_bytes: int = 1 << 20) -> DataFrame:
    """(row, lang_pred, score) per row of ``docs``; one map stage."""
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return packed(docs, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    load = share(docs.sparkSession, model)  # bounded by the training sample
    # Texts without a letter get size 0 and cost nothing.
    rows = packed(docs, F.when(letters, F.octet_length(text)).otherwise(0).alias("size"))
    schema = T.StructType([rows.schema["row"], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])

    def run(batches):
        import pyarrow as pa
        m = load()
        for b in batches:
            sizes = b.column("size").to_pylist()
            texts = b.column("row").field(text)
            langs: list[str] = []
            scores: list[float] = []
            for lo, hi in slices_by_bytes(sizes, batch_bytes):
                some = sizes[lo:hi]
                lang, score = m.predict([t if n else None for t, n in zip(texts.slice(lo, hi - lo).to_pylist(), some)])
                langs += [x if n else UNKNOWN for x, n in zip(lang, some)]
                scores += [x if n else 0.0 for x, n in zip(score, some)]
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["row", "lang_pred", "score"])
        give_back_memory()

    return rows.mapInArrow(run, schema)


def identify(docs: DataFrame, model: PpmModel | None, text: str = "text") -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score`` (in place of columns so
    called)."""
    out = ("lang_pred", "score")
    return identified(docs, model, text).select(*unpacked(docs.columns, out), *out)

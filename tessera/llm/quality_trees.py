"""Quality by histogram gradient-boosted trees over document statistics
(operator 12).

One pass over the whole texts turns each into ``FEATURES`` numbers: shares of
character classes, word lengths, repeated words, word triples and lines. They
are counted in numpy over the bytes of many texts at once; words, triples and
lines are compared by a 64-bit polynomial hash that is read off running sums.
A text longer than ``STRETCH`` bytes is counted in stretches, cut at white
space, whose counts add up: repeats are then those within a stretch.

Training sees a bounded sample (``docs_per_class`` rows per label) and only
its statistics, never its texts. Each feature is cut into at most ``bins``
quantile bins; every level of every tree takes, per node, the split with the
largest gain of the logistic loss from gradient histograms. Trees are stored
as complete binary trees in heap order, flattened into arrays (feature and
threshold per inner node, value per leaf), so scoring walks all rows and all
trees down one level per numpy step, without a branch.

Defined results: null and empty texts have statistics 0 (blank ones no words,
only lines) and get the score those have; without both labels every score is 0.5; repeated rows get
equal results; a row is learned from once per matching label row; labels that
are null or neither 0 nor 1 and label rows without an id are not learned
from; rows whose id is null are scored; ties between splits go to the first
feature and lowest threshold; very long texts are read whole, in stretches;
extra columns are kept, those called like an output replaced; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import ship_package

from tessera.llm.common import give_back_memory, materialize, packed, share, unpacked
from tessera.llm.langid import sample_per_class
from tessera.llm.token_counts import slices_by_bytes

STRETCH = 1 << 20
FEATURES = ("log_words", "log_chars", "word_chars", "short_words", "long_words", "lower", "upper", "digits", "stops",
            "marks", "beyond_ascii", "title_words", "marked_words", "distinct_words", "same_as_last", "distinct_triples",
            "lines_per_word", "distinct_lines", "blank_lines", "shouted_words")

# Classes of bytes.
SPACE, LOWER, UPPER, DIGIT, STOP, MARK, LEAD, INNER = range(8)
STOPS = b".,;:!?'\"()-"


def byte_classes():
    import numpy as np
    kind = np.full(256, MARK, np.uint8)
    kind[[0x20, *range(0x09, 0x0E)]] = SPACE
    kind[ord("a"):ord("z") + 1] = LOWER
    kind[ord("A"):ord("Z") + 1] = UPPER
    kind[ord("0"):ord("9") + 1] = DIGIT
    kind[list(STOPS)] = STOP
    kind[0x80:0xC0] = INNER
    kind[0xC0:] = LEAD
    return kind


def stretches(raw: bytes, most: int = STRETCH) -> Iterator[bytes]:
    """``raw`` in parts of at most ``most`` bytes, cut after white space
    where a part has any."""
    at = 0
    while len(raw) - at > most:
        cut = max(raw.rfind(c, at, at + most) for c in (b" ", b"\n", b"\t")) + 1
        cut = cut if cut > at else at + most
        yield raw[at:cut]
        at = cut
    yield raw[at:]


class TextCounter:
    """Counts per text, for lists of texts as UTF-8 bytes."""

    BASE, INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)

    def __init__(self):
        import numpy as np
        self.kind = byte_classes()
        self.code = np.random.default_rng(20_240_301).integers(1, 1 << 63, 256, dtype=np.uint64)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        """Powers of the hash's base and of its inverse, for ``n`` places."""
        import numpy as np
        if len(self.powers) < n:
            for name, base in (("powers", self.BASE), ("inverses", self.INVERSE)):
                steps = np.full(max(n, STRETCH + 1024), base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    @staticmethod
    def _distinct(owner, hashes, n: int):
        """Different hashes per owner."""
        import numpy as np
        keys = np.unique((hashes << np.uint64(20)) | owner.astype(np.uint64))
        return np.bincount((keys & np.uint64((1 << 20) - 1)).astype(np.int64), minlength=n)

    def counts(self, parts: Sequence[bytes]):
        """Whole numbers per part, one column each (see ``features_of``)."""
        import numpy as np
        n = len(parts)
        data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)  # a line end behind each part
        sizes = np.array([len(p) + 1 for p in parts], np.int64)
        owner = np.repeat(np.arange(n), sizes)
        kind = self.kind[data]
        by_kind = np.bincount(owner * 8 + kind, minlength=8 * n).reshape(n, 8)
        by_kind[:, SPACE] -= 1

        self._reach(len(data) + 1)
        run = np.cumsum(self.code[data] * self.powers[:len(data)], dtype=np.uint64)

        def hashes(start, end):
            before = np.where(start > 0, run[np.maximum(start, 1) - 1], np.uint64(0))
            return (run[end - 1] - before) * self.inverses[start]

        blank = kind == SPACE
        edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        if not blank[0]:
            edge = np.r_[0, edge]
        start, end = edge[::2], edge[1::2]  # the buffer ends in white space
        words = len(start)
        mine = owner[start]
        inner = np.r_[0, np.cumsum(kind == INNER)]
        length = end - start - (inner[end] - inner[start])
        upper = np.r_[0, np.cumsum(kind == UPPER)]
        lower = np.r_[0, np.cumsum(kind == LOWER)]
        shouted = (upper[end] - upper[start] > 1) & (lower[end] == lower[start])
        value = hashes(start, end)
        same = np.zeros(words, bool)
        same[1:] = (value[1:] == value[:-1]) & (mine[1:] == mine[:-1])
        whole = mine[2:] == mine[:-2]
        triple = (value[:-2] * np.uint64(0xC2B2AE3D27D4EB4F) + value[1:-1] * np.uint64(0x165667B19E3779F9) + value[2:])[whole]

        ends = np.flatnonzero(data == 0x0A)
        begin = np.r_[0, ends[:-1] + 1]
        seen = np.r_[0, np.cumsum(~blank)]
        full = seen[ends] > seen[begin]
        of = owner[ends]
        line = hashes(begin[full], ends[full])

        def total(flags, of=mine):
            return np.bincount(of, flags, n)

        return np.column_stack([
            by_kind, total(None), total(length), total(length <= 3), total(length >= 12), total(kind[start] == UPPER),
            total(kind[end - 1] == MARK), total(shouted), self._distinct(mine, value, n), total(same),
            total(None, mine[2:][whole]), self._distinct(mine[2:][whole], triple, n),
            total(None, of), total(None, of[full]), self._distinct(of[full], line, n)]).astype(np.float64)

    def features(self, raws: Sequence[bytes | None], most: int = STRETCH):
        """(texts x features): every text whole, in buffers of about ``most``
        bytes."""
        import numpy as np
        out = np.zeros((len(raws), 22))
        parts: list[bytes] = []
        of: list[int] = []
        size = 0

        def flush():
            if parts:
                np.add.at(out, np.array(of), self.counts(parts))
                parts.clear()
                of.clear()

        for i, raw in enumerate(raws):
            for part in stretches(raw, most) if raw else ():
                if size + len(part) > most or len(parts) >= 1 << 16:
                    flush()
                    size = 0
                parts.append(part)
                of.append(i)
                size += len(part)
        flush()
        return features_of(out)


def features_of(c):
    """Shares and logarithms from the counts."""
    import numpy as np
    kinds, (words, word_chars, short, long_, title, marked, shouted, distinct, same, triples, distinct_triples,
            lines, full, distinct_lines) = c[:, :8], c[:, 8:].T
    chars = kinds.sum(axis=1) - kinds[:, INNER]
    w, ch = np.maximum(words, 1), np.maximum(chars, 1)
    return np.column_stack([
        np.log1p(words), np.log1p(chars), word_chars / w, short / w, long_ / w, kinds[:, LOWER] / ch, kinds[:, UPPER] / ch,
        kinds[:, DIGIT] / ch, kinds[:, STOP] / ch, kinds[:, MARK] / ch, kinds[:, LEAD] / ch, title / w, marked / w,
        distinct / w, same / w, distinct_triples / np.maximum(triples, 1), full / w, distinct_lines / np.maximum(full, 1),
        (lines - full) / np.maximum(lines, 1), shouted / w])


class BoostedTrees:
    """Complete binary trees in heap order, as arrays: ``feature`` and
    ``threshold`` (trees x inner nodes; larger values go right), ``value``
    (trees x leaves), and the start value."""

    def __init__(self, feature, threshold, value, start: float):
        self.feature, self.threshold, self.value, self.start = feature, threshold, value, start

    def margin(self, x, rows: int = 4096):
        import numpy as np
        trees, inner = self.feature.shape
        out = np.full(len(x), self.start)
        all_trees = np.arange(trees)[None, :]
        for lo in range(0, len(x), rows):  # bounded work space
            part = x[lo:lo + rows]
            at = np.zeros((len(part), trees), np.int64)
            row = np.arange(len(part))[:, None]
            for _ in range((inner + 1).bit_length() - 1):
                right = part[row, self.feature[all_trees, at]] > self.threshold[all_trees, at]
                at = 2 * at + 1 + right
            out[lo:lo + rows] += self.value[all_trees, at - inner].sum(axis=1)
        return out

    def probability(self, x):
        import numpy as np
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -500, 500)))


def bin_edges(x, bins: int) -> list:
    """Per feature, rising thresholds between neighbouring different values
    nearest the quantiles (fewer where values are few)."""
    import numpy as np
    out = []
    for col in x.T:
        values = np.unique(col)
        middles = (values[1:] + values[:-1]) / 2
        if len(middles) >= bins:
            at = np.searchsorted(values, np.quantile(col, np.arange(1, bins) / bins))
            middles = middles[np.unique(np.minimum(at, len(middles) - 1))]
        out.append(middles)
    return out


def fit(x, y, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15, ridge: float = 1.0,
        least_rows: float = 8.0) -> BoostedTrees:
    """Gradient boosting of the logistic loss by histograms."""
    import numpy as np
    x, y = np.asarray(x, np.float64), np.asarray(y, np.float64)
    n, d = x.shape
    edges = bin_edges(x, bins)
    binned = np.column_stack([np.searchsorted(e, col, side="left") for e, col in zip(edges, x.T)]).astype(np.int64)
    usable = np.arange(bins)[None, :] < np.array([len(e) for e in edges])[:, None]  # split after bin b
    inner, leaves = (1 << depth) - 1, 1 << depth
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)  # without a split all rows go left
    value = np.zeros((trees, leaves))
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    start = float(np.log(share / (1 - share)))
    margin = np.full(n, start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        at = np.zeros(n, np.int64)  # within the level
        for level in range(depth):
            nodes = 1 << level
            hist = np.empty((3, nodes, d, bins))
            for f in range(d):
                place = at * bins + binned[:, f]
                for k, w in enumerate((g, h, None)):
                    hist[k, :, f] = np.bincount(place, w, nodes * bins).reshape(nodes, bins)
            left = hist.cumsum(axis=3)
            whole = left[:, :, :1, -1:]
            right = whole - left
            gain = left[0] ** 2 / (left[1] + ridge) + right[0] ** 2 / (right[1] + ridge) - whole[0] ** 2 / (whole[1] + ridge)
            gain[~(usable[None] & (left[2] >= least_rows) & (right[2] >= least_rows))] = 0.0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            base = nodes - 1
            for k in range(nodes):
                f, b = divmod(int(best[k]), bins)
                if gain[k, f, b] > 1e-9:
                    feature[t, base + k], threshold[t, base + k] = f, edges[f][b]
            at = 2 * at + (x[np.arange(n), feature[t, base + at]] > threshold[t, base + at])
        value[t] = -rate * np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + ridge)
        margin += value[t][at]
    return BoostedTrees(feature, threshold, value, start)


def with_statistics(docs: DataFrame, text: str = "text", batch_bytes: int = 1 << 22) -> DataFrame:
    """(row, stats) per row of ``docs``; one map stage over whole texts."""
    ship_package()
    rows = packed(docs, F.col(text).cast("binary").alias("raw"), F.coalesce(F.octet_length(text), F.lit(0)).alias("size"))
    schema = T.StructType([rows.schema["row"], T.StructField("stats", T.ArrayType(T.DoubleType()))])

    def run(batches):
        import numpy as np
        import pyarrow as pa
        counter = TextCounter()
        for b in batches:
            for lo, hi in slices_by_bytes(b.column("size").to_pylist(), batch_bytes):
                x = counter.features(b.column("raw").slice(lo, hi - lo).to_pylist())
                stats = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([b.column("row").slice(lo, hi - lo), stats], names=["row", "stats"])
        give_back_memory()

    return rows.mapInArrow(run, schema)


def learn(table: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality",
          docs_per_class: int = 10_000, **options) -> BoostedTrees | None:
    """Trees from the rows (row, stats) that ``labels`` marks 0 or 1, or None
    without both. The sample is cut on the narrow label table; the driver
    gets the statistics of at most ``docs_per_class`` rows per label."""
    import numpy as np
    marks = (labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull())
             .select(F.col(key).alias("key"), F.col(label).alias("y"), F.lit("").alias("text")))
    chosen = sample_per_class(marks, "y", "key", docs_per_class).select(F.col("key").alias("_k"), "y")
    got = (table.select(F.col("row")[key].alias("_key"), "stats")
           .join(F.broadcast(chosen), F.col("_key") == F.col("_k"))  # bounded by the sample
           .select("_key", "stats", "y").collect())
    got = sorted((str(r["_key"]), r["stats"], r["y"]) for r in got)  # the same model whatever the order of tasks
    if len({y for _, _, y in got}) < 2:
        return None
    return fit(np.array([x for _, x, _ in got]), np.array([y for _, _, y in got]), **options)


def scored(table: DataFrame, model: BoostedTrees | None, names: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """The fields ``names`` of ``row`` plus ``score`` and ``predicted``, from
    (row, stats)."""
    out = ("score", "predicted")
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    if model is None:
        return table.select(*unpacked(names, out), F.lit(0.5).alias("score"), F.lit(int(0.5 >= threshold)).alias("predicted"))
    load = share(table.sparkSession, model)  # bounded by trees x nodes
    schema = T.StructType([table.schema["row"], T.StructField("score", T.DoubleType())])

    def run(batches):
        import pyarrow as pa
        m = load()
        for b in batches:
            x = b.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(m.probability(x))], names=["row", "score"])

    return table.mapInArrow(run, schema).select(*unpacked(names, out), "score", predicted)


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
             threshold: float = 0.5, learn_from: str | None = None, **options) -> DataFrame:
    """``docs`` without the text, plus ``score`` and ``predicted``. Texts are
    read once; their statistics are written, learned from (rows for which
    the boolean column ``learn_from`` holds, if given) and scored."""
    names = [c for c in docs.columns if c != text]
    kept = with_statistics(docs, text).select(F.struct(*[F.col("row")[c].alias(c) for c in names]).alias("row"), "stats")
    table = materialize(kept, "quality-stats")
    seen = table if learn_from is None else table.filter(F.col("row")[learn_from])
    return scored(table, learn(seen, labels, key, label, **options), names, threshold)

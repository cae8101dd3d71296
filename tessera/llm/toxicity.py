"""Toxicity by subword-bag embeddings and a linear softmax (operator 1).

A word is a bag of character n-grams (3 to 5, with word borders) and itself;
its vector is the mean of their embeddings, a window's vector the mean of
its words', and a two-class linear softmax on top is trained jointly with
the embeddings in numpy. A misspelt word that was never seen shares most
n-grams with known ones, so its vector lies near theirs.

Labels belong to whole texts, while a few words make a text toxic. Training
therefore starts with every window carrying its text's label and then
repeats, keeping for toxic texts only their highest windows (multiple
instance learning). A text's score comes from its highest window, over the
whole text, through a logistic curve with the number of windows as a second
input, fitted on texts the windows were not trained on.

The model is learned on a bounded sample (at most ``docs_per_class`` texts
per label); scoring reads every text whole. The number of windows is an input
of the final curve because a long text has more chances of a high window, so
a clean text's score also moves with its length. Since averaging and softmax are
linear up to the last step, a word contributes one number, which workers
cache by word.

Defined results: null and empty texts have one empty window (the score a
text without words gets); without both labels every score is 0.5; labels of
null or repeated rows: a row is learned from once per matching label row;
tokens without a letter count as empty words; very long texts are scored
whole, in slices by bytes; extra columns are kept, those called like an output replaced; an empty table
gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import TwoTierCache, packed, share, unpacked, worker_state
from tessera.llm.langid import sample_per_class
from tessera.llm.token_counts import slices_by_bytes

WINDOW = 6
SHORT = 48
LONGEST = 32


def pieces(token: str) -> list[str]:
    """Normalised words of a white-space token: lower case, letters and
    digits kept, long ones cut into stretches of ``LONGEST`` characters. A
    token without a letter (a number) has none; in mixed ones such as
    ``1d10t5`` digits count like letters."""
    w = "".join(c for c in token.lower() if c.isalnum())
    if not any(c.isalpha() for c in w):
        return []
    return [w[i:i + LONGEST] for i in range(0, len(w), LONGEST)]


def bag_tokens(text: str | None) -> list[str]:
    """White-space tokens, a token repeated at once counted once."""
    tokens = text.split() if text else []
    return [t for t, last in zip(tokens, [None, *tokens]) if t != last]


def subwords(word: str) -> list[str]:
    x = f"<{word}>"
    return [x] + [x[i:i + n] for n in (3, 4, 5) for i in range(len(x) - n + 1) if n < len(x)]


class SubwordModel:
    """Embeddings of the known subwords, the softmax and the final curve."""

    def __init__(self, index: dict[str, int], embeddings, weights, bias, curve):
        self.index, self.embeddings, self.weights, self.bias, self.curve = index, embeddings, weights, bias, curve
        self.logits = None

    def word_logit(self, token: str) -> float:
        """The token's share of a window's log odds (mean of its subwords
        under the softmax, summed over its pieces)."""
        if self.logits is None:  # softmax of two classes: the difference counts
            self.logits = (self.embeddings @ (self.weights[:, 1] - self.weights[:, 0])).tolist()
        total = 0.0
        for w in pieces(token):
            known = [self.logits[i] for i in map(self.index.get, subwords(w)) if i is not None]
            if known:
                total += sum(known) / len(known)
        return total

    def highest(self, values, sizes):
        """Per text, the highest window's log odds: windows of ``WINDOW``
        consecutive words at every position (a shorter text is one)."""
        import numpy as np
        values = np.asarray(values, np.float64)
        sizes = np.asarray(sizes, np.int64)
        bias = float(self.bias[1] - self.bias[0])
        ends = np.cumsum(sizes)
        starts = ends - sizes
        total = np.r_[0.0, np.cumsum(values)]
        at = np.arange(len(values))
        owner = np.repeat(np.arange(len(sizes)), sizes)
        last = np.minimum(at + WINDOW, ends[owner]) if len(at) else at
        first = np.maximum(np.minimum(at, last - WINDOW), starts[owner]) if len(at) else at
        window = (total[last] - total[first]) / WINDOW
        out = np.full(len(sizes), bias)
        some = sizes > 0
        if some.any():
            out[some] += np.maximum.reduceat(window, starts[some])
        return out

    def probability(self, top, sizes):
        import numpy as np
        a, b, c = self.curve
        z = a * np.asarray(top) + b * length_input(sizes) + c
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))

    def score(self, texts: Sequence[str | None], cache: TwoTierCache):
        values: list[float] = []
        sizes: list[int] = []
        for t in texts:
            words = bag_tokens(t)
            sizes.append(len(words))
            for w in words:
                v = cache.lookup(w)
                if v is None:
                    v = self.word_logit(w)
                    if len(w) <= 64:
                        cache.put(w, v)
                values.append(v)
        return self.probability(self.highest(values, sizes), sizes)


def length_input(sizes):
    """Log number of words; texts below ``SHORT`` words count as that long,
    so the curve is not carried on to lengths it was not fitted on."""
    import numpy as np
    return np.log(np.maximum(np.asarray(sizes, np.float64), SHORT))


def fit_curve(top, sizes, y, steps: int = 200):
    """Logistic fit on (highest log odds, log number of words), by Newton
    steps with a little ridge."""
    import numpy as np
    x = np.c_[top, length_input(sizes), np.ones(len(y))]
    w = np.zeros(3)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + 1e-2 * w
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3)
        step = np.linalg.solve(h, g)
        w -= step * min(1.0, 5.0 / np.abs(step).max())
        if np.abs(step).max() < 1e-6:
            break
    return tuple(w.tolist())


def train(texts: Sequence[str], labels: Sequence[int], dim: int = 16, min_texts: int = 5, rounds: int = 4,
          epochs: int = 4, batch: int = 512, rate: float = 0.5, keep_top: int = 3, seed: int = 7) -> SubwordModel:
    """Joint training of embeddings and softmax on windows; three quarters
    of the texts train, the rest fit the final curve."""
    import numpy as np
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    texts, y = [texts[i] for i in order], np.asarray(labels, np.float64)[order]
    fit = np.arange(len(texts)) % 4 != 3

    words: dict[str, int] = {}
    docs = [np.array([words.setdefault(w, len(words)) for tok in bag_tokens(t) for w in pieces(tok)], np.int64)
            for t in texts]
    # Subwords found in enough texts of the sample.
    subs = [subwords(w) for w in words]
    found: dict[str, int] = {}
    for d, use in zip(docs, fit):
        if use:
            for s in {s for i in set(d.tolist()) for s in subs[i]}:
                found[s] = found.get(s, 0) + 1
    index = {s: i for i, s in enumerate(sorted(s for s, n in found.items() if n >= min_texts))}
    parts = [[index[s] for s in x if s in index] for x in subs]
    sizes = np.array([len(p) for p in parts], np.int64)
    flat = np.array([i for p in parts for i in p], np.int64)
    start = np.cumsum(sizes) - sizes

    embeddings = rng.normal(0, 0.1, (len(index), dim))
    weights, bias = rng.normal(0, 0.1, (dim, 2)), np.zeros(2)
    moments_e, moments_w = np.full(len(index), 1e-8), np.full(dim, 1e-8)

    def cut(d):
        return [d[i:i + WINDOW] for i in range(0, len(d), WINDOW)]

    windows = [(w, k) for k, d in enumerate(docs) if fit[k] for w in cut(d)]
    owner = np.array([k for _, k in windows], np.int64)

    def bag(which):
        """(subword, weight, row) triples of the windows' means."""
        ws = [windows[i][0] for i in which]
        n = np.array([len(w) for w in ws])
        word = np.concatenate(ws) if len(ws) else np.empty(0, np.int64)
        row = np.repeat(np.arange(len(ws)), n)
        s = sizes[word]
        sub = flat[np.repeat(start[word] - (np.cumsum(s) - s), s) + np.arange(s.sum())]
        return sub, np.repeat(1.0 / np.maximum(s, 1), s) / WINDOW, np.repeat(row, s), len(ws)

    def logits(which):
        out = []
        for i in range(0, len(which), 4096):
            sub, w, row, n = bag(which[i:i + 4096])
            d = embeddings @ (weights[:, 1] - weights[:, 0])
            out.append(np.bincount(row, d[sub] * w, n) + bias[1] - bias[0])
        return np.concatenate(out) if out else np.empty(0)

    use = np.arange(len(windows))
    for r in range(rounds):
        positive = use[y[owner[use]] == 1]
        negative = np.flatnonzero(y[owner] == 0)
        if r:  # the hardest clean windows, and as many at random
            z = logits(negative)
            hard = negative[np.argsort(-z)[:2 * len(positive) + 1]]
            negative = np.r_[hard, rng.permutation(negative)[:2 * len(positive) + 1]]
        train_on = np.r_[positive, negative]
        share = len(positive) / max(1, len(negative))
        for _ in range(epochs):
            for i in np.array_split(rng.permutation(train_on), max(1, len(train_on) // batch)):
                if not len(i):
                    continue
                sub, w, row, n = bag(i)
                v = weights[:, 1] - weights[:, 0]
                x = np.stack([np.bincount(row, embeddings[sub, j] * w, n) for j in range(dim)], axis=1)
                z = x @ v + bias[1] - bias[0]
                t = y[owner[i]]
                e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - t) * np.where(t == 1, 1.0, share)
                touched = np.bincount(sub, w * e[row], len(index))
                gw = x.T @ e
                moments_e += touched ** 2
                moments_w += gw ** 2
                embeddings -= rate * (touched / np.sqrt(moments_e))[:, None] * v * 0.5
                step = rate * 0.2 * gw / np.sqrt(moments_w)
                weights[:, 1] -= step / 2
                weights[:, 0] += step / 2
                bias += np.array([1, -1]) * 0.02 * e.mean()
        z = logits(np.arange(len(windows)))
        toxic = np.flatnonzero(y[owner] == 1)
        by_doc = toxic[np.lexsort((-z[toxic], owner[toxic]))]
        place = np.arange(len(by_doc)) - np.searchsorted(owner[by_doc], owner[by_doc])
        use = np.r_[by_doc[place < keep_top], np.flatnonzero(y[owner] == 0)]

    model = SubwordModel(index, embeddings, weights, bias, (1.0, 0.0, 0.0))
    rest = [i for i in range(len(texts)) if not fit[i]]
    counts, tops = [], []
    for i in rest:
        tokens = bag_tokens(texts[i])
        counts.append(len(tokens))
        tops.append(float(model.highest([model.word_logit(w) for w in tokens], [len(tokens)])[0]))
    model.curve = fit_curve(np.array(tops), np.array(counts), y[rest])
    return model


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "toxic",
          docs_per_class: int = 700, max_chars: int = 20_000) -> SubwordModel | None:
    """A model from the rows of ``docs`` that ``labels`` marks 0 or 1, or
    None without both. The sample is drawn per label among the texts of at
    most ``max_chars`` characters; where a label has too few of them, the
    first ``max_chars`` characters of longer ones fill up. Labels meet the
    lengths of the texts first, so only the sample's texts are exchanged."""
    marks = (labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull())
             .select(F.col(key).alias("key"), F.col(label).alias("y")))
    sizes = docs.filter(F.col("text").isNotNull()).select(
        F.col(key).alias("key"), (F.length("text") > max_chars).alias("long")).distinct()
    sized = marks.join(sizes, "key").select("key", F.struct("y", "long").alias("kind"), F.lit("").alias("text"))
    chosen = sample_per_class(sized, "kind", "key", docs_per_class).select(F.col("key").alias("_k"), "kind.*")
    texts = docs.select(F.col(key).alias("key"), (F.length("text") > max_chars).alias("_long"),
                        F.substring("text", 1, max_chars).alias("text"))
    got = texts.join(F.broadcast(chosen),  # bounded by the sample
                     (F.col("key") == F.col("_k")) & (F.col("_long") == F.col("long"))).select("key", "text", "y", "long").collect()
    kept: dict[int, list[tuple[str, str]]] = {}
    for _, k, text, y in sorted((r["long"], str(r["key"]), r["text"], r["y"]) for r in got):
        if len(kept.setdefault(y, [])) < docs_per_class:
            kept[y].append((k, text))
    if len(kept) < 2:
        return None
    both = sorted((k, text, y) for y, rows in kept.items() for k, text in rows)
    return train([t for _, t, _ in both], [y for _, _, y in both])


def scored(docs: DataFrame, model: SubwordModel | None, text: str = "text", threshold: float = 0.7,
           cache_size: int = 300_000, batch_bytes: int = 4 << 20) -> DataFrame:
    """``docs`` plus ``score`` and ``predicted`` (in place of columns so
    called); one map stage, no shuffle."""
    out = ("score", "predicted")
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    if model is None:
        return packed(docs, F.lit(0.5).alias("score")).select(*unpacked(docs.columns, out), "score", predicted)
    load, model_id = share(docs.sparkSession, model), uuid.uuid4().hex  # bounded by the training sample
    rows = packed(docs, F.coalesce(F.octet_length(text), F.lit(0)).alias("size"))
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])

    def run(batches):
        import pyarrow as pa
        m = load()
        cache = worker_state(("toxic", model_id), lambda: TwoTierCache(cache_size))
        for b in batches:
            texts = b.column("row").field(text)
            z: list[float] = []
            for lo, hi in slices_by_bytes(b.column("size").to_pylist(), batch_bytes):
                z += m.score(texts.slice(lo, hi - lo).to_pylist(), cache).tolist()
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(z, pa.float64())], names=["row", "score"])

    return rows.mapInArrow(run, schema).select(*unpacked(docs.columns, out), "score", predicted)

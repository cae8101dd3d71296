"""Vector code compression with geometric near-neighbour access trees
(operator 13).

Components become integers, floor(scale * x), and vectors are cut into
``parts`` equal consecutive parts, each with a codebook of ``size`` entries:
at first that part of the vectors with the smallest ids, then, ``rounds``
times, every entry becomes the componentwise floor of the mean of the parts
nearest to it (squared Euclidean distance, ties to the lower index; an entry
without parts stays). A vector's code is the index of its nearest entry per
part.

Nearest entries are found by a GNAT over each codebook: a node has a few
split points, every other entry belongs to the child of its nearest split
point, and the node stores, per split point and child, the range of the
distances from the one to the entries of the other. A query computes its
distances to the split points; with r the best distance so far, a child whose
range at some split point lies wholly outside [d - r, d + r] cannot hold an
entry as near, and goes as a whole. All rows of a batch walk the tree
together, each child with the rows that still need it.

Everything is exact. Squared distances are integers; ranges, query distances
and r are whole numbers rounded outwards (down where a bound is a least one,
up where it is a most one), and a child goes only where its least possible
distance is strictly above r. So entries at the same distance are always
compared, by their integer squared distances and then their indices.

Spark keeps the rows: each round is one map over the written table that adds
up integer sums per task, combined by entry; the driver sees the codebooks
only (parts x size entries).

Defined results: rows whose vector is null or holds null or non-finite
components are dropped; null ids are kept and come after all others; repeated
ids are kept row by row (ordered by vector where codebooks start); vectors
shorter than the longest, or whose length is no multiple of ``parts``, count
as filled with zeros; with fewer rows than ``size`` the codebooks are that
small; magnitudes beyond 2^24 after scaling are computed with unbounded
integers, and an error beyond 64 bits is given as the largest long; equal
vectors get equal codes; very long vectors are coded whole; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import ship_package

from tessera.llm.common import give_back_memory, materialize, scratch, share

SAFE = 1 << 24      # largest scaled magnitude whose squares and sums stay within 64 bits
LIMB = 30           # bits of a limb of a sum
LARGEST = (1 << 63) - 1


def scaled(vector: Sequence[float], scale: int) -> list[int]:
    """floor(scale * x) as unbounded integers, exact for every double."""
    return [math.floor(x * scale) if abs(x) < 1e15 else int(x) * scale for x in vector]


def floor_root(squares):
    """Whole part of the square root of non-negative integers."""
    import numpy as np
    if squares.dtype == object:
        return np.array([math.isqrt(x) for x in squares.ravel().tolist()], object).reshape(squares.shape)
    root = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    root -= root * root > squares
    root += (root + 1) * (root + 1) <= squares
    return root


def squared_distances(a, b):
    """(rows of a x rows of b) integer squared distances."""
    import numpy as np
    out = np.zeros((len(a), len(b)), a.dtype)
    for j in range(a.shape[1]):
        gap = a[:, j, None] - b[None, :, j]
        out += gap * gap
    return out


@dataclass
class Node:
    """``splits``: entry indices. Per child the node below it (or None), and
    per (split, child) the least and most distance, rounded outwards."""

    splits: list[int]
    children: list["Node | None"]
    least: list[list[int]] = field(default_factory=list)
    most: list[list[int]] = field(default_factory=list)


class Gnat:
    """The tree over one codebook (integer entries)."""

    def __init__(self, entries, degree: int = 4):
        self.entries, self.degree = entries, degree
        self.root = self._build(list(range(len(entries))))

    def _build(self, mine: list[int]) -> Node | None:
        import numpy as np
        if not mine:
            return None
        points = self.entries[mine].astype(object)
        # Split points far apart: the first entry, then the one farthest from those chosen.
        chosen = [0]
        near = squared_distances(points, points[:1])[:, 0]
        while len(chosen) < min(self.degree, len(mine)):
            k = max((i for i in range(len(mine)) if i not in chosen), key=lambda i: (near[i], -i))
            chosen.append(k)
            near = np.minimum(near, squared_distances(points, points[k:k + 1])[:, 0])
        square = squared_distances(points[chosen], points)  # splits x entries
        low = floor_root(square)
        high = low + (low * low < square)
        groups: list[list[int]] = [[] for _ in chosen]
        for i in range(len(mine)):
            if i not in chosen:
                groups[min(range(len(chosen)), key=lambda s: (square[s][i], s))].append(i)
        node = Node([mine[i] for i in chosen], [self._build([mine[i] for i in g]) for g in groups])
        for s in range(len(chosen)):
            node.least.append([min((low[s][i] for i in g), default=0) for g in groups])
            node.most.append([max((high[s][i] for i in g), default=0) for g in groups])
        return node

    def nearest(self, queries):
        """(index, integer squared distance) of each query's nearest entry,
        ties to the lower index, and the number of distances computed."""
        import numpy as np
        n = len(queries)
        entries = self.entries.astype(queries.dtype)
        best = np.zeros(n, np.int64)
        square = np.full(n, -1, queries.dtype)  # -1: none yet
        radius = np.zeros(n, queries.dtype)     # of the best so far, rounded up
        computed = 0
        waiting: list[tuple[Node, object, object]] = [(self.root, np.arange(n), None)]
        while waiting:
            node, rows, at_least = waiting.pop()
            if at_least is not None:  # what was found since may rule it out
                rows = rows[at_least <= radius[rows]]
            if not len(rows):
                continue
            d2 = squared_distances(queries[rows], entries[node.splits])
            computed += d2.size
            for k, entry in enumerate(node.splits):
                now, old = d2[:, k], square[rows]
                better = (old < 0) | (now < old) | ((now == old) & (entry < best[rows]))
                at = rows[better]
                best[at], square[at] = entry, now[better]
            low = floor_root(square[rows])
            radius[rows] = low + (low * low < square[rows])
            down = floor_root(d2)
            up = down + (down * down < d2)
            later = []
            for c, child in enumerate(node.children):
                if child is None:
                    continue
                bound = np.zeros(len(rows), queries.dtype)
                for s in range(len(node.splits)):
                    bound = np.maximum(bound, np.maximum(down[:, s] - node.most[s][c], node.least[s][c] - up[:, s]))
                stay = bound <= radius[rows]
                if stay.any():
                    later.append((child, rows[stay], bound[stay]))
            waiting += later[::-1]
        return best, square, computed


class Codebooks:
    """One codebook and its tree per part, with the integer entries."""

    def __init__(self, books: list[list[list[int]]], width: int, scale: int):
        self.books, self.width, self.scale = books, width, scale

    def trees(self) -> list[Gnat]:
        import numpy as np
        part = self.width // len(self.books)
        return [Gnat(np.array(b, object).reshape(len(b), part)) for b in self.books]

    @property
    def large(self) -> bool:
        return any(abs(x) >= SAFE for book in self.books for e in book for x in e)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(x) for b in self.books for e in b for x in e).encode()).hexdigest()


def _arrays(column, width: int, scale: int, wide: bool):
    """Yields (row numbers, integer matrix): rows of ordinary magnitude as 64-bit
    integers, the others (or all, with ``wide``) as unbounded ones."""
    import numpy as np
    import pyarrow.compute as pc
    n = len(column)
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = np.zeros((n, width))
    row = np.repeat(np.arange(n), sizes)
    x[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    # Scaling by a power of two is exact; the bound also keeps large sums within 64 bits.
    plain = np.zeros(n, bool) if wide else (np.abs(x) < SAFE / scale).all(axis=1)
    if plain.any():
        yield np.flatnonzero(plain), np.floor(x[plain] * scale).astype(np.int64)
    if not plain.all():
        rest = np.flatnonzero(~plain)
        yield rest, np.array([scaled(v, scale) for v in x[rest].tolist()], object).reshape(len(rest), width)


def _limbs(x: int) -> list[int]:
    """``x`` in limbs of ``LIMB`` bits, lowest first, the last one signed."""
    out = []
    while not -(1 << LIMB) <= x < 1 << LIMB:
        out.append(x & ((1 << LIMB) - 1))
        x >>= LIMB
    return [*out, x]


def _sums(rows: DataFrame, books: Codebooks, batch: int = 8192) -> DataFrame:
    """(part, entry, place, limb, total): component sums of the parts nearest
    to each entry, as limbs; place -1 has their number."""
    load = share(rows.sparkSession, books)  # bounded: parts x size entries

    def run(batches):
        import numpy as np
        import pyarrow as pa
        b = load()
        trees, wide = b.trees(), b.large
        part = b.width // len(trees)
        sums: dict[tuple[int, int], list[int]] = {}
        for whole in batches:
            for lo in range(0, whole.num_rows, batch):
                for _, q in _arrays(whole.column("vec").slice(lo, batch), b.width, b.scale, wide):
                    for p, tree in enumerate(trees):
                        mine = q[:, p * part:(p + 1) * part]
                        code, _, _ = tree.nearest(mine)
                        order = np.argsort(code, kind="stable")
                        used, first, count = np.unique(code[order], return_index=True, return_counts=True)
                        total = (np.add.reduceat(mine[order], first, axis=0) if part else np.zeros((len(used), 0), np.int64))
                        for k, n, t in zip(used.tolist(), count.tolist(), total.tolist()):
                            old = sums.setdefault((p, k), [0] * (part + 1))
                            sums[p, k] = [a + c for a, c in zip(old, [n, *t])]
        out = [(p, k, place - 1, limb, value) for (p, k), t in sums.items() for place, x in enumerate(t)
               for limb, value in enumerate(_limbs(int(x)))]
        cols = list(zip(*out)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64() if i == 4 else pa.int32()) for i, c in enumerate(cols)],
            names=["part", "entry", "place", "limb", "total"])
        give_back_memory()

    partial = rows.select("vec").mapInArrow(run, "part int, entry int, place int, limb int, total long")
    return partial.groupBy("part", "entry", "place", "limb").agg(F.sum("total").alias("total"))


def train(rows: DataFrame, width: int, parts: int = 8, size: int = 16, rounds: int = 6, scale: int = 4096) -> Codebooks:
    """Codebooks from the written rows (id, vec)."""
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vec").select("vec").limit(size).collect()
    start = [scaled([*r["vec"], *[0.0] * (width - len(r["vec"]))], scale) for r in first]
    part = width // parts
    books = Codebooks([[v[p * part:(p + 1) * part] for v in start] for p in range(parts)], width, scale)
    for _ in range(rounds):
        totals: dict[tuple[int, int], dict[int, int]] = {}
        for r in _sums(rows, books).collect():  # bounded: parts x size x places of a part
            of = totals.setdefault((r["part"], r["entry"]), {})
            of[r["place"]] = of.get(r["place"], 0) + (r["total"] << (LIMB * r["limb"]))
        after = [[list(e) for e in b] for b in books.books]
        for (p, k), t in totals.items():
            after[p][k] = [t[j] // t[-1] for j in range(part)]
        books = Codebooks(after, width, scale)
    return books


def coded(rows: DataFrame, books: Codebooks, carry: Sequence[str] = (), batch: int = 8192) -> DataFrame:
    """(id, code, error, and the columns ``carry``) per row of (id, vec, ...)."""
    load = share(rows.sparkSession, books)  # bounded: parts x size entries
    keep = ["id", *carry]
    schema = T.StructType([*[rows.schema[c] for c in keep], T.StructField("code", T.StringType()),
                           T.StructField("error", T.LongType())])

    def run(batches):
        import numpy as np
        import pyarrow as pa
        b = load()
        trees, wide = b.trees(), b.large
        part = b.width // len(trees)
        for whole in batches:
            for lo in range(0, whole.num_rows, batch):
                some = whole.slice(lo, batch)
                codes = np.zeros((some.num_rows, len(trees)), np.uint8)
                error = [0] * some.num_rows
                for at, q in _arrays(some.column("vec"), b.width, b.scale, wide):
                    total = np.zeros(len(at), q.dtype)
                    for p, tree in enumerate(trees):
                        code, square, _ = tree.nearest(q[:, p * part:(p + 1) * part])
                        codes[at, p] = code
                        total = total + square
                    for i, e in zip(at.tolist(), total.tolist()):
                        error[i] = min(int(e), LARGEST)
                text = codes.tobytes().hex()
                step = 2 * len(trees)
                yield pa.RecordBatch.from_arrays(
                    [*[some.column(c) for c in keep],
                     pa.array([text[i:i + step] for i in range(0, len(text), step)], pa.string()),
                     pa.array(error, pa.int64())], names=[*keep, "code", "error"])
        give_back_memory()

    return rows.select(*keep, "vec").mapInArrow(run, schema)


def compress(table: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 8,
             size: int = 16, rounds: int = 6, scale: int = 4096) -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256) per kept row."""
    if not 0 < size <= 256 or parts < 1 or scale < 1 or scale & (scale - 1):
        raise ValueError("size is at most 256, parts at least 1, scale a power of two")
    with scratch(table.sparkSession):
        return materialize(_compress(table, key, vector, label, parts, size, rounds, scale), "codes-answer", keep=True)


def _compress(table: DataFrame, key: str, vector: str, label: str, parts: int, size: int, rounds: int,
              scale: int) -> DataFrame:
    ship_package()
    fine = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                    & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    rows = materialize(table.filter(F.col(vector).isNotNull() & F.coalesce(fine, F.lit(False))).select(
        F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vec")), "codes-rows")
    longest = rows.agg(F.max(F.size("vec"))).first()[0] or 0
    books = train(rows, -(-longest // parts) * parts, parts, size, rounds, scale)
    answers = materialize(coded(rows, books, ["label"]), "codes-rows-coded")
    # Written, so that the join reads both sides freshly and a hot label's rows can be split.
    totals = answers.groupBy("label").agg(
        F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
    totals = materialize(totals.select(F.col("label").alias("_label"), F.least("total", F.lit(LARGEST)).cast("long").alias(
        "label_error")), "codes-labels")
    return answers.join(totals, F.col("label").eqNullSafe(F.col("_label"))).select(
        F.col("id").alias(key), "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))

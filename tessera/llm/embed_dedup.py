"""Embedding near-duplicates by a subspace pigeonhole join (operator 6).

Unit vectors with cosine >= c are at squared distance <= 2 - 2c. Rotated
vectors are split into blocks of few dimensions, each with a share of that
budget in proportion to the block's variance. If the whole distance is
within budget, at least one block's distance is within its share, so the
union of the per-block range joins holds every pair (no pair is lost), and
the cosine of the union's pairs is then computed exactly, in double
precision, from the vectors as stored.

* *Rotation*: the principal axes of a bounded sample, dealt to the blocks in
  turn; any rotation is exact, this one makes blocks alike.
* *Range join of a block*: a k-d tree fitted on the sample cuts the block's
  space into leaves of about ``leaf_rows`` vectors. Each vector has a home
  leaf and visits every later leaf whose box is within the block's radius.
  The rows of a (leaf, visiting leaf) pair travel as one pack, divided by
  hash where a leaf is larger than planned, and a task compares two packs.
* *Each pair once*: a pair counts in the first block whose share it keeps,
  so a linked pair is met exactly once; packs send back link counts per
  vector and one edge per vector to the smallest partner, never the pairs.

Equal vectors are joined to one class with a multiplicity first; classes have
numbers of their own and are the nodes of the graph. Vectors of different
lengths never meet: the length is part of every pack's key, and each length
has its own index.

Each vector keeps at least one edge (to its smallest partner in a pack
pair), and further ones that connect its other partners there, so the edges
connect what the links connect.

Defined results: vectors that are null, empty, zero or hold null or
non-finite components link with nothing and are their own component; all
others are compared within their length, whatever their magnitude; equal
vectors link with each other; every row is judged by its own vector, whatever
its id: repeated ids are counted row by row, and a component's id is its
smallest, null only if all its ids are; an empty table gives an empty result;
extra columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import materialize, scratch, share
from tessera.llm.components import components


def steady(vectors):
    """Rows scaled by the power of two that brings their largest component to
    about 1: no rounding, and no finite vector overflows or vanishes when
    squared."""
    import numpy as np
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def unit(vectors):
    import numpy as np
    x = steady(vectors)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class SubspaceIndex:
    """Rotation, block budgets and one k-d tree per block, from a sample."""

    def __init__(self, sample, budget: float, block_dims: int, leaves: int):
        import numpy as np
        units = unit(sample)
        d = units.shape[1]
        self.axes = None  # too few vectors for axes: any rotation is exact, none too
        if len(units) > max(1, d):
            self.axes = np.ascontiguousarray(np.linalg.eigh(np.cov(units.T) if d > 1 else np.eye(d))[1][:, ::-1])
        blocks = max(1, round(d / block_dims))
        self.dims = [np.arange(b, d, blocks) for b in range(blocks)]
        rotated = self.rotate(units)
        spread = np.array([rotated[:, x].var(axis=0).sum() + 1e-9 for x in self.dims])
        # A little room for rounding: the shares still sum to the budget at least.
        self.budgets = budget * spread / spread.sum() + 1e-9
        self.trees = [self._tree(rotated[:, x], leaves) for x in self.dims]

    @staticmethod
    def _tree(points, leaves: int) -> list[tuple[int, float]]:
        """Heap of (dimension, threshold): the median of the widest
        dimension, down to ``leaves`` (a power of two) leaves."""
        import numpy as np
        nodes: list[tuple[int, float]] = []
        level = [points]
        while len(level) < leaves:
            following = []
            for p in level:
                if len(p):
                    axis = int(p.var(axis=0).argmax())
                    cut = float(np.median(p[:, axis]))
                else:
                    axis, cut = 0, 0.0
                nodes.append((axis, cut))
                right = p[:, axis] >= cut if len(p) else np.empty(0, bool)
                following += [p[~right], p[right]]
            level = following
        return nodes

    def rotate(self, vectors):
        return unit(vectors) if self.axes is None else unit(vectors) @ self.axes

    def leaves_of(self, block: int, points):
        """(row, leaf) of the home leaf and of every leaf within reach."""
        import numpy as np
        nodes, budget = self.trees[block], self.budgets[block]
        depth = (len(nodes) + 1).bit_length() - 1
        home = np.zeros(len(points), np.int64)
        rows = np.arange(len(points))
        at = np.zeros(len(points), np.int64)
        gaps = np.zeros(points.shape)  # distance to the box, per dimension
        axis = np.array([a for a, _ in nodes] or [0])
        cut = np.array([c for _, c in nodes] or [0.0])
        for level in range(depth):
            node = home + (1 << level) - 1
            home = 2 * home + (points[np.arange(len(points)), axis[node]] >= cut[node])
            node = at + (1 << level) - 1
            a = axis[node]
            delta = points[rows, a] - cut[node]
            right = delta >= 0
            near = 2 * at + right
            far_gap = gaps.copy()
            k = np.arange(len(rows))
            far_gap[k, a] = np.maximum(far_gap[k, a], np.abs(delta))
            go = (far_gap ** 2).sum(axis=1) <= budget + 1e-12
            rows = np.concatenate([rows, rows[go]])
            at = np.concatenate([near, (2 * at + ~right)[go]])
            gaps = np.concatenate([gaps, far_gap[go]])
        return home, rows, at


def _links(index: SubspaceIndex, block: int, a, b, same: bool, least: float, tile: int = 1024):
    """Yield (i, j) index arrays of linked pairs of two packs that this
    block answers for."""
    import numpy as np
    a, b = steady(a), steady(b)
    ra, rb = index.rotate(a), index.rotate(b)
    dims, budget = index.dims[block], index.budgets[block]
    xa, xb = ra[:, dims].astype(np.float32), rb[:, dims].astype(np.float32)
    na, nb = (xa * xa).sum(axis=1), (xb * xb).sum(axis=1)
    norm_a, norm_b = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    for s in range(0, len(a), tile):
        first = s if same else 0
        distance = na[s:s + tile, None] + nb[None, first:] - 2.0 * (xa[s:s + tile] @ xb[first:].T)
        i, j = np.nonzero(distance <= budget + 1e-5)  # single precision, with room for its rounding
        i, j = i + s, j + first
        if same:
            i, j = i[j > i], j[j > i]
        for t in range(0, len(i), 1 << 16):
            p, q = i[t:t + (1 << 16)], j[t:t + (1 << 16)]
            cosine = (a[p] * b[q]).sum(axis=1) / (norm_a[p] * norm_b[q])
            p, q = p[cosine >= least], q[cosine >= least]
            # The first block within its share answers for the pair.
            mine = np.ones(len(p), bool)
            for k in range(block + 1):
                gap = ra[np.ix_(p, index.dims[k])] - rb[np.ix_(q, index.dims[k])]
                within = (gap * gap).sum(axis=1) <= index.budgets[k]
                mine &= ~within if k < block else within
            yield p[mine], q[mine]


class LengthIndexes:
    """An index per vector length found in the sample, with the parts that a
    leaf's packs are dealt to; any other length gets an index without cuts,
    whose one block has the whole budget."""

    def __init__(self, sample: list[list[float]], total: int, budget: float, block_dims: int, leaf_rows: int):
        import numpy as np
        self.budget, self.known = budget, {}
        for d in sorted({len(v) for v in sample}):
            some = np.array([v for v in sample if len(v) == d], np.float64)
            n = -(-total * len(some) // len(sample))  # about so many in all
            leaves = 1
            while leaves * leaf_rows < n and leaves * 8 < len(some):
                leaves *= 2
            # More packs a leaf where the sample cannot cut finer.
            self.known[d] = (SubspaceIndex(some, budget, block_dims, leaves), max(1, -(-n // (leaves * leaf_rows))))

    def of(self, d: int) -> tuple[SubspaceIndex, int]:
        import numpy as np
        return self.known.get(d) or (SubspaceIndex(np.ones((1, d)), self.budget, d, 1), 1)


def _sample(vectors: DataFrame, rows: int) -> tuple[int, list[list[float]]]:
    """The number of vectors, and at most ``rows`` of them, the lowest by
    hash."""
    n = vectors.count()
    share = min(1.0, (rows + 100) / max(1, n))
    h = F.pmod(F.xxhash64("vec", F.lit("sample")), F.lit(1 << 30))
    got = vectors.filter(h < F.lit(int(share * (1 << 30)))).select(h.alias("h"), "vec").orderBy("h", "vec").limit(rows)
    return n, [r["vec"] for r in got.collect()]


def near_duplicates(table: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.9,
                    block_dims: int = 16, leaf_rows: int = 8192, sample_rows: int = 16_384) -> DataFrame:
    """(key, n_links, component_id, kept) per row of ``table``."""
    with scratch(table.sparkSession):
        answer = _near_duplicates(table, key, vector, least, block_dims, leaf_rows, sample_rows)
        return materialize(answer, "vec-answer", keep=True)


def _near_duplicates(table: DataFrame, key: str, vector: str, least: float, block_dims: int, leaf_rows: int,
                     sample_rows: int) -> DataFrame:
    v = F.col(vector).cast("array<double>")
    usable = F.coalesce(
        F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(v, lambda x: x != 0.0), F.lit(False))
    rows = materialize(table.select(F.col(key).alias("id"), F.when(usable, F.col(vector)).alias("vec"))
                       .withColumn("digest", F.when(F.col("vec").isNotNull(),
                                                    F.md5(F.to_json(F.struct("vec"))))), "vec-rows")
    classes = rows.filter("vec IS NOT NULL").groupBy("digest").agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("vec").alias("vec"))
    classes = materialize(classes.withColumn("class", F.monotonically_increasing_id()), "vec-classes")
    found = materialize(_join(classes.select("class", "copies", "vec"), least, block_dims, leaf_rows, sample_rows), "vec-found")
    counts = materialize(found.filter("links > 0").groupBy(F.col("u").alias("class")).agg(F.sum("links").alias("links")),
                         "vec-counts")
    groups = materialize(components(found.filter("v IS NOT NULL").select("u", "v")).withColumnRenamed("node", "class"), "vec-groups")
    own = classes.select("digest", "class", "least", "copies").join(counts, "class", "left").join(groups, "class", "left")
    own = materialize(own.withColumn("component", F.coalesce("component", "class")), "vec-own")
    ids = materialize(own.groupBy("component").agg(F.min("least").alias("component_id")), "vec-ids")  # nulls only if all are
    own = own.join(ids, "component").select(F.col("digest").alias("_d"), "component_id", (
        F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    alone = rows.filter("digest IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    linked = rows.filter("digest IS NOT NULL").select("id", "digest").join(
        materialize(own, "vec-components"), F.col("digest") == F.col("_d")).select("id", F.col("n_links").cast("long"), "component_id")
    return linked.unionByName(alone).select(F.col("id").alias(key), "n_links", "component_id",
                                            F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _join(classes: DataFrame, least: float, block_dims: int, leaf_rows: int, sample_rows: int) -> DataFrame:
    """(u, links, v): link counts by class, and edges u-v (links 0) that
    connect linked classes."""
    n, sample = _sample(classes, sample_rows)
    indexes = LengthIndexes(sample, n, 2.0 - 2.0 * least + 1e-9, block_dims, leaf_rows)
    shared = share(classes.sparkSession, indexes)  # bounded by the sample
    where = ["length", "block", "home", "leaf", "part"]
    place = T.StructType([classes.schema["class"], classes.schema["copies"], classes.schema["vec"],
                          *[T.StructField(c, T.LongType()) for c in where]])

    def visit(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        ix = shared()
        for whole in batches:
            for lo in range(0, whole.num_rows, 1024):
                b = whole.slice(lo, 1024)
                sizes = pc.list_value_length(b.column("vec")).to_numpy(zero_copy_only=False)
                for d in np.unique(sizes).tolist():
                    mine = b.take(pa.array(np.flatnonzero(sizes == d)))
                    index, parts = ix.of(d)
                    raw = mine.column("vec").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                    rotated = index.rotate(raw.reshape(mine.num_rows, -1))
                    mixed = np.asarray(mine.column("class")).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    dealt = ((mixed >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)
                    for block, dims in enumerate(index.dims):
                        home, row, leaf = index.leaves_of(block, rotated[:, dims])
                        use = leaf >= home[row]
                        row, leaf = row[use], leaf[use]
                        at, n = pa.array(row, pa.int64()), len(row)
                        yield pa.RecordBatch.from_arrays(
                            [mine.column(c).take(at) for c in ("class", "copies", "vec")]
                            + [pa.array(x, pa.int64()) for x in (np.full(n, d), np.full(n, block), home[row], leaf, dealt[row])],
                            names=["class", "copies", "vec", *where])

    visits = classes.mapInArrow(visit, place)
    # A pack holds the rows of one home leaf (or a hashed part of it) that
    # visit one leaf: bounded by the leaf size.
    packs = visits.groupBy(*where).agg(F.collect_list(F.struct("class", "copies", "vec")).alias("pack"))
    packs = materialize(packs.select(*where, F.col("pack.class").alias("ids"), F.col("pack.copies").alias("copies"),
                                     F.flatten("pack.vec").alias("vecs")), "vec-packs")
    homes = packs.filter("home = leaf").select("length", "block", "leaf", *[F.col(c).alias(f"{c}2") for c in
                                                                           ("part", "ids", "copies", "vecs")])
    tasks = packs.join(homes, ["length", "block", "leaf"]).filter("home <> leaf OR part <= part2")
    result = T.StructType([T.StructField(c, T.LongType()) for c in ("u", "links", "v")])

    def compare(batches):
        import numpy as np
        import pyarrow as pa
        ix = shared()
        for batch in batches:
            for k in range(batch.num_rows):
                width = batch.column("length")[k].as_py()

                def side(ids: str, copies: str, vecs: str):
                    x = batch.column(vecs)[k].values.to_numpy(zero_copy_only=False).astype(np.float64)
                    return (batch.column(ids)[k].values, batch.column(copies)[k].values.to_numpy(zero_copy_only=False),
                            x.reshape(-1, width))
                id_a, m_a, a = side("ids", "copies", "vecs")
                id_b, m_b, b = side("ids2", "copies2", "vecs2")
                same = (batch.column("home")[k].as_py() == batch.column("leaf")[k].as_py()
                        and batch.column("part")[k].as_py() == batch.column("part2")[k].as_py())
                count_a, count_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
                edges_i, edges_j = [], []
                joined = _Forest(len(a) + (0 if same else len(b)))
                shift = 0 if same else len(a)
                for i, j in _links(ix.of(width)[0], batch.column("block")[k].as_py(), a, b, same, least):
                    np.add.at(count_a, i, m_b[j])
                    np.add.at(count_b, j, m_a[i])
                    for x in joined.connect(i, j + shift):
                        edges_i.append(i[x])
                        edges_j.append(j[x])
                for ids, count in ((id_a, count_a), (id_b, count_b)):
                    some = np.flatnonzero(count)
                    if len(some):
                        yield pa.RecordBatch.from_arrays(
                            [ids.take(pa.array(some)), pa.array(count[some], pa.int64()),
                             pa.nulls(len(some), ids.type)], names=["u", "links", "v"])
                if edges_i:
                    i, j = np.concatenate(edges_i), np.concatenate(edges_j)
                    yield pa.RecordBatch.from_arrays(
                        [id_a.take(pa.array(i)), pa.array(np.zeros(len(i), np.int64)), id_b.take(pa.array(j))],
                        names=["u", "links", "v"])

    return tasks.mapInArrow(compare, result)


class _Forest:
    """Keeps, of a stream of links within two packs, the few that connect
    what was apart (at most rows - 1 in all)."""

    def __init__(self, n: int):
        self.root = list(range(n))

    def find(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def connect(self, i, j):
        import numpy as np
        keep = []
        labels = np.array([self.find(x) for x in range(len(self.root))]) if len(i) > len(self.root) else None
        if labels is not None:  # many links: most are inside a group already
            todo = np.flatnonzero(labels[i] != labels[j])
            pair = np.stack([np.minimum(labels[i[todo]], labels[j[todo]]), np.maximum(labels[i[todo]], labels[j[todo]])])
            todo = todo[np.unique(pair, axis=1, return_index=True)[1]] if len(todo) else todo
        else:
            todo = np.arange(len(i))
        for k in todo.tolist():
            x, y = self.find(int(i[k])), self.find(int(j[k]))
            if x != y:
                self.root[max(x, y)] = min(x, y)
                keep.append(k)
        if keep:
            yield np.array(keep, np.int64)

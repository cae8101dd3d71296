"""MinHash near-duplicates by a chosen-path similarity join (operator 8).

A document is the set of its word shingles (64-bit hashes); documents whose
sets have Jaccard similarity of at least the threshold are linked, and a
group is what links connect.

1. *Classes.* Documents with the same set (size and 128-bit digest) are one
   class, a node of the graph by a number of its own; its first row (smallest
   id, then a hash of id and text) stands for it. Copies are never paired.
2. *Chosen paths.* Each class carries a sketch of minwise values. In every
   one of ``trees`` independent trees a node sends a document to a child for
   each sketch position the node chooses (one, and a second with probability
   1 / threshold - 1, so a pair at the threshold is expected to stay
   together at least once per level); documents with the same value there
   share the child. All trees run in one table per level; only rows of nodes
   with more than ``small`` documents go on, up to ``levels`` levels.
3. *Dense nodes.* Documents still in a large node at ``pivot_level`` are
   mostly alike, and branching would not part them. In the first
   ``pivot_trees`` trees they are compared with a few pivots of the node, and
   what these links connect needs no further comparison: a large group of near
   copies costs rows x pivots and not all its pairs. What the pivots leave
   apart is settled inside tasks, on full sets: only documents with a possible
   partner in another group travel, and a task returns the links that span
   their groups, never its pairs (:func:`_settle_dense`). Two documents that
   met there are not compared again.
4. *Nodes.* Small nodes of every level, and all nodes of the last, that
   still hold several groups are compared exhaustively, in packs of at most
   ``PACK`` rows: only pairs of different groups whose sizes and binned
   minima allow the threshold, and that did not meet in a dense node, leave a
   task.
5. *Verification* on the full sets, each document's best candidate first,
   then those pairs that the links do not connect yet.

No pair is left out once found. A pair at the threshold is missed with a
probability of about 2.8e-4 at 16 trees and five levels, where it stays in
large nodes down to the last (1e-4 at similarity 0.82; below 1e-5 where nodes
are small by the third level), or with one of 3e-5 by the estimate, whose limit lies four
deviations below the threshold. Groups come from
:mod:`tessera.llm.components`.

Defined results: null texts and texts without words have an empty set, are
linked with nothing and keep their own id as component; with fewer words
than a shingle has, the whole sequence is one shingle; every row is judged
by its own text, whatever its id: a component's id is its smallest, null
only if all its ids are; of each group the first row is kept, and rows equal
to it in id and text; very long texts are read whole (their minwise values in
steps of bounded size, their sets in small packs); ties between candidates go
to the larger ids; an empty table gives an empty result; extra columns are not
read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import ship_package

from tessera.llm.common import WORD, give_back_memory, materialize, scratch
from tessera.llm.components import components

SKETCH = 64  # minwise values that choose paths
BINS = 512   # binned minima, a byte each, that estimate similarity
PACK = 512   # rows of a node compared at a time
FILTER_BITS = 24


def shingles(text: Column, words: int) -> Column:
    """Distinct hashes of the text's word shingles, ASCII letters lowered."""
    lowered = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.transform(F.array(F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))), lambda w: F.when(
        F.size(w) == 0, F.array().cast("array<bigint>")).when(
        F.size(w) < words, F.array(F.xxhash64(F.lit("short"), w))).otherwise(
        F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(w) - words),
                                     lambda i: F.xxhash64(*[w[i + k] for k in range(words)])))))[0]


def row_key(key: str, text: str) -> Column:
    """A 128-bit hash of id and text."""
    name = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))
    return F.unhex(F.md5(F.concat(name, F.lit("\0"), F.coalesce(F.col(text), F.lit("")))))


def sketches(docs: DataFrame, text: str, key: str, words: int, carry: Sequence[str] = ()) -> DataFrame:
    """(id, n, digest, sketch, bins, _row_key) per row: set size, digest of the sorted
    set, ``SKETCH`` minwise values of 32 bits, and for each of ``BINS`` equal
    ranges of a mixed hash a byte of the smallest value in it (0: none);
    null for an empty set. Plus the columns of ``carry``."""
    ship_package()
    carry = ["_row_key", *carry]
    docs = docs.withColumn("_row_key", row_key(key, text))
    schema = T.StructType([T.StructField("id", docs.schema[key].dataType), T.StructField("n", T.LongType()),
                           T.StructField("digest", T.BinaryType()), T.StructField("sketch", T.ArrayType(T.IntegerType())),
                           T.StructField("bins", T.BinaryType()), *[docs.schema[c] for c in carry]])

    def run(batches):
        import hashlib
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        rng = np.random.default_rng(20_240_229)
        mult = rng.integers(1, 1 << 63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        add = rng.integers(0, 1 << 63, SKETCH, dtype=np.uint64)
        few = (whole.slice(at, 1000) for whole in batches for at in range(0, whole.num_rows, 1000))
        for b in few:  # bounded work space
            sets = b.column("set")
            values = sets.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            ends = np.cumsum(pc.list_value_length(sets).to_numpy(zero_copy_only=False).astype(np.int64))
            digests, mins, bins, sizes = [], [], [], []
            start = 0
            for end in ends.tolist():
                x = np.sort(values[start:end])
                start = end
                sizes.append(len(x))
                if not len(x):
                    digests.append(None)
                    mins.append(None)
                    bins.append(None)
                    continue
                digests.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest())
                low = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
                for i in range(0, len(x), 1 << 14):  # bounded work space for very long texts
                    # Multiply-add, then mixed: a minwise order per position.
                    h = x[i:i + (1 << 14), None] * mult + add
                    h ^= h >> np.uint64(29)
                    h *= np.uint64(0x9E3779B97F4A7C15)
                    low = np.minimum(low, h.min(axis=0))
                mins.append((low >> np.uint64(32)).astype(np.uint32).view(np.int32))
                y = np.sort((x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93))
                place, first = np.unique(y >> np.uint64(64 - BINS.bit_length() + 1), return_index=True)
                row = np.zeros(BINS, np.uint8)
                # Low bits, as the high ones of a bin's minimum are not spread evenly.
                row[place.astype(np.int64)] = ((y[first] >> np.uint64(8)) % np.uint64(255) + np.uint64(1)).astype(np.uint8)
                bins.append(row.tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(mins, pa.list_(pa.int32())), pa.array(bins, pa.binary()), *[b.column(c) for c in carry]],
                names=["id", "n", "digest", "sketch", "bins", *carry])
        give_back_memory()

    rows = docs.select(F.col(key).alias("id"), shingles(F.col(text), words).alias("set"), *carry)
    return rows.mapInArrow(run, schema)


def least_estimate(threshold: float, either, total):
    """Least estimate of a pair at the threshold, four deviations below it.
    The filled bins are a sample without replacement from the union, which
    has at most total / (1 + threshold) elements if the pair reaches the
    threshold; small sets fill a bin of their own each and leave little to
    chance."""
    import numpy as np
    union = total / (1.0 + threshold)
    share = np.clip((union - either) / np.maximum(union - 1.0, 1.0), 0.0, 1.0)
    return threshold - 4.0 * np.sqrt(threshold * (1.0 - threshold) / either * share) - 1.0 / either


def estimates(a, b, total, threshold: float):
    """Estimated similarity of rows of binned minima, row by row, for sets of
    ``total`` elements together, and whether it allows the threshold."""
    import numpy as np

    def count(flags):
        return np.bitwise_count(np.packbits(flags, axis=1).view(np.uint64)).sum(axis=1, dtype=np.int64)

    either = np.maximum(count((a | b) != 0), 1)
    same = count(a == b) - (BINS - either)  # bins empty in both are equal too
    guess = same / either
    return guess, guess >= least_estimate(threshold, either, total)


def _children(rows: DataFrame, extra: float) -> DataFrame:
    """Rows (node, id, sketch) to rows (node, id) of the next level: the
    node's hash chooses one or two sketch positions. A node's lowest bit
    (set in the trees that look for pivots) is handed down."""
    first = F.pmod(F.xxhash64("node", F.lit("first")), F.lit(SKETCH)).cast("int")
    second = F.pmod(first + 1 + F.pmod(F.xxhash64("node", F.lit("second")), F.lit(SKETCH - 1)), F.lit(SKETCH)).cast("int")
    two = F.pmod(F.xxhash64("node", F.lit("two")), F.lit(1 << 20)) < F.lit(int(extra * (1 << 20)))
    at = F.when(two, F.array(first, second)).otherwise(F.array(first))
    child = _flagged(F.xxhash64("node", "at", F.col("sketch")[F.col("at")]), F.col("node").bitwiseAND(F.lit(1)))
    return rows.select("id", "node", "sketch", F.explode(at).alias("at")).select(child.alias("node"), "id")


def _flagged(h: Column, flag: Column) -> Column:
    """A hash whose lowest bit is ``flag`` (never 0 or 1 but by a chance of
    2^-63)."""
    return h.bitwiseAND(F.lit(-2)).bitwiseOR(flag)


def _shared(rows: DataFrame, name: str) -> DataFrame:
    """Rows of nodes that hold more than one document, with the node's size.
    Sizes are combined map-side and written, so the join back reads both
    sides freshly and a hot node can be split; the rows themselves are made
    from the sketches twice, which is cheaper than writing them."""
    sizes = materialize(rows.groupBy("node").count().filter("count > 1"), f"{name}-sizes")
    return materialize(rows.join(sizes, "node"), name)


def _pivot_pairs(many: DataFrame, sketch: DataFrame, pivots: int, threshold: float) -> DataFrame:
    """(a, b, estimate): rows of a large node with the node's pivots (the ids
    lowest in as many hash orders, found by combined minima) that can reach
    the threshold."""
    lowest = [F.min(F.struct(F.xxhash64(F.lit(j), F.col("id")), F.col("id").alias("id"))).alias(f"p{j}")
              for j in range(pivots)]
    per_node = materialize(many.groupBy("node").agg(*lowest).select(
        "node", F.array_distinct(F.array(*[F.col(f"p{j}.id") for j in range(pivots)])).alias("pivots")), "dup-pivots")
    pairs = many.join(per_node, "node").select("id", F.explode("pivots").alias("p")).filter("id <> p")
    pairs = pairs.select(F.least("id", "p").alias("a"), F.greatest("id", "p").alias("b")).distinct()
    a = sketch.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("bins").alias("bins_a"))
    b = sketch.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("bins").alias("bins_b"))
    joined = pairs.join(a, "a").join(b, "b").filter(
        F.least("n_a", "n_b") >= F.lit(threshold - 1e-9) * F.greatest("n_a", "n_b"))
    schema = T.StructType([pairs.schema["a"], pairs.schema["b"], T.StructField("estimate", T.DoubleType())])

    def run(batches):
        import numpy as np
        import pyarrow as pa
        for x in batches:
            if not x.num_rows:
                continue
            bins_a, bins_b = (np.frombuffer(b"".join(x.column(c).to_pylist()), np.uint8).reshape(-1, BINS)
                              for c in ("bins_a", "bins_b"))
            guess, near = estimates(bins_a, bins_b, np.asarray(x.column("total")), threshold)
            at = pa.array(np.flatnonzero(near))
            yield pa.RecordBatch.from_arrays([x.column("a").take(at), x.column("b").take(at), pa.array(guess[near])],
                                             names=["a", "b", "estimate"])

    total = (F.col("n_a") + F.col("n_b")).cast("double").alias("total")
    return joined.select("a", "b", "bins_a", "bins_b", total).mapInArrow(run, schema)


def _tasks(rows: DataFrame, columns: Sequence[str], most: int, name: str) -> DataFrame:
    """(node, same, pack, pack2): rows (node, id, n, ...) as packs of about
    ``most`` rows and at most about 2^19 shingles (long sets make small
    packs), dealt by a hash in nodes with more; packs of a node meet
    pairwise."""
    sizes = materialize(rows.groupBy("node").agg(F.count(F.lit(1)).alias("count"), F.sum("n").alias("sum")), f"{name}-sizes")
    parts = F.ceil(F.greatest(F.col("count") / F.lit(most), F.col("sum") / F.lit(1 << 19 if "set" in columns else 1 << 40)))
    dealt = rows.join(sizes, "node").withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int"))
    packs = dealt.groupBy("node", "part").agg(F.collect_list(F.struct(*columns)).alias("pack"))  # bounded as above
    packs = materialize(packs, f"{name}-packs")
    other = packs.select("node", F.col("part").alias("part2"), F.col("pack").alias("pack2"))
    return packs.join(other, "node").filter("part <= part2").select(
        "node", (F.col("part") == F.col("part2")).alias("same"), "pack", "pack2")


class _Pack:
    """The columns of a pack as arrays."""

    def __init__(self, values, none: int):
        import numpy as np
        self.values, self.id = values, values.field("id")
        self.g, self.n = np.asarray(values.field("g")), np.asarray(values.field("n"))
        self.bins = np.frombuffer(b"".join(values.field("bins").to_pylist()), np.uint8).reshape(-1, BINS)
        self.done = None
        if values.type.get_field_index("done") >= 0:
            lists = values.field("done").to_pylist()
            self.done = np.full((len(lists), max(map(len, lists), default=0)), none, np.int64)
            for i, x in enumerate(lists):
                self.done[i, :len(x)] = x


def _meeting(batch, k: int) -> tuple[_Pack, _Pack, bool]:
    return (_Pack(batch.column("pack")[k].values, 0), _Pack(batch.column("pack2")[k].values, 1),
            batch.column("same")[k].as_py())  # no node has the number 0 or 1: see _flagged


def _passing(a: _Pack, b: _Pack, same: bool, threshold: float, step: int = 1 << 13):
    """Yields (i, j, estimate) arrays: pairs of different groups that can
    reach the threshold and were not compared in a dense node."""
    import numpy as np
    large = np.maximum(a.n[:, None], b.n[None, :])
    fit = (np.minimum(a.n[:, None], b.n[None, :]) >= (threshold - 1e-9) * large) & (a.g[:, None] != b.g[None, :])
    if same:
        fit &= np.arange(len(a.n))[:, None] < np.arange(len(b.n))[None, :]
    left, right = np.nonzero(fit)
    for s in range(0, len(left), step):  # bounded work space
        i, j = left[s:s + step], right[s:s + step]
        guess, near = estimates(a.bins[i], b.bins[j], (a.n[i] + b.n[j]).astype(np.float64), threshold)
        i, j, guess = i[near], j[near], guess[near]
        if a.done is not None and len(i):
            apart = ~(a.done[i][:, :, None] == b.done[j][:, None, :]).any(axis=(1, 2))
            i, j, guess = i[apart], j[apart], guess[apart]
        if len(i):
            yield i, j, guess


def _node_pairs(rows: DataFrame, sketch: DataFrame, groups: DataFrame | None, done: DataFrame, threshold: float) -> DataFrame:
    """(a, b, estimate), distinct: pairs of a node's rows (node, id) that lie
    in different groups and can reach the threshold, less those that ``done``
    (id, nodes) names as compared. Nodes of one group are dropped."""
    rows = materialize(_mixed(rows, groups), "dup-mixed").join(sketch.select("id", "n", "bins"), "id")
    rows = rows.join(done, "id", "left").withColumn("done", F.coalesce("nodes", F.array().cast("array<long>")))
    tasks = _tasks(rows, ["id", "g", "n", "bins", "done"], PACK // 2, "dup-pairs").drop("node")
    id_type = sketch.schema["id"].dataType
    schema = T.StructType([T.StructField("a", id_type), T.StructField("b", id_type),
                           T.StructField("estimate", T.DoubleType())])

    def run(batches):
        import pyarrow as pa
        for x in batches:
            for k in range(x.num_rows):
                a, b, same = _meeting(x, k)
                for i, j, guess in _passing(a, b, same, threshold):
                    yield pa.RecordBatch.from_arrays([a.id.take(pa.array(i)), b.id.take(pa.array(j)), pa.array(guess)],
                                                     names=["a", "b", "estimate"])
        give_back_memory()

    found = tasks.mapInArrow(run, schema)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "estimate").distinct()


def _involved(rows: DataFrame, sketch: DataFrame, threshold: float) -> DataFrame:
    """(node, id), distinct: rows (node, id, g) of a node with a partner in
    another group that can reach the threshold. Tasks return a row per pair
    of packs."""
    tasks = _tasks(rows.join(sketch.select("id", "n", "bins"), "id"), ["id", "g", "n", "bins"], PACK // 2, "dup-dense")
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("ids", T.ArrayType(sketch.schema["id"].dataType))])

    def run(batches):
        import numpy as np
        import pyarrow as pa
        for x in batches:
            for k in range(x.num_rows):
                a, b, same = _meeting(x, k)
                of_a, of_b = np.zeros(len(a.n), bool), np.zeros(len(b.n), bool)
                for i, j, _ in _passing(a, b, same, threshold):
                    of_a[i], of_b[j] = True, True
                ids = np.unique(np.r_[np.asarray(a.id)[of_a], np.asarray(b.id)[of_b]])
                if len(ids):
                    yield pa.RecordBatch.from_arrays([x.column("node").slice(k, 1), pa.array([ids], pa.list_(pa.int64()))],
                                                     names=["node", "ids"])
        give_back_memory()

    return tasks.mapInArrow(run, schema).select("node", F.explode("ids").alias("id")).distinct()


def _spanning_links(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b), distinct: from rows (node, id, g, n, bins, set) the links, on
    full sets, that connect the groups of each pair of packs as all its links
    would; at most rows - 1 each, whatever the number of links."""
    columns = ["id", "g", "n", "bins", "set"]
    tasks = _tasks(rows, columns, PACK, "dup-exact").drop("node")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def sets(pack):
            lists = pack.values.field("set")
            return [np.sort(lists[i].values.to_numpy()) for i in range(len(lists))]

        for x in batches:
            for k in range(x.num_rows):
                a, b, same = _meeting(x, k)
                sets_a = sets(a)
                sets_b = sets_a if same else sets(b)
                pairs = [np.concatenate(c) for c in zip(*((i, j) for i, j, _ in _passing(a, b, same, percent / 100.0)))]
                if not pairs:
                    continue
                labels, group = np.unique(np.r_[a.g, b.g], return_inverse=True)
                group_a, group_b = group[:len(a.g)], group[len(a.g):]
                root = np.arange(len(labels))
                order = np.argsort(pairs[0], kind="stable")
                left, right = pairs[0][order], pairs[1][order]
                first = np.flatnonzero(np.r_[True, left[1:] != left[:-1]])
                found: list[tuple[int, int]] = []
                for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(left)]):
                    i = int(left[lo])
                    apart = right[lo:hi][root[group_b[right[lo:hi]]] != root[group_a[i]]]
                    mine, at = sets_a[i], 0
                    while at < len(apart):  # partners together, up to a bounded number of shingles
                        sizes = b.n[apart[at:]].cumsum()
                        some = apart[at:at + max(1, int(np.searchsorted(sizes, 1 << 20)))]
                        at += len(some)
                        many = np.concatenate([sets_b[j] for j in some.tolist()])
                        place = np.minimum(np.searchsorted(mine, many), len(mine) - 1)
                        hits = np.r_[0, np.cumsum(mine[place] == many)]
                        ends = np.r_[0, b.n[some].cumsum()]
                        both = hits[ends[1:]] - hits[ends[:-1]]
                        linked = 100 * both >= percent * (len(mine) + b.n[some] - both)
                        for j in some[linked].tolist():
                            u, v = root[group_a[i]], root[group_b[j]]
                            if u != v:
                                root[root == max(u, v)] = min(u, v)
                                found.append((i, j))
                if found:
                    i, j = (pa.array(c) for c in zip(*found))
                    yield pa.RecordBatch.from_arrays([a.id.take(i), b.id.take(j)], names=["a", "b"])
        give_back_memory()

    found = tasks.mapInArrow(run, schema)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _settle_dense(flagged: DataFrame, sketch: DataFrame, links: "_Links", threshold: float) -> DataFrame:
    """Compares the dense nodes that the pivots left with several groups, on
    full sets inside the tasks: rows with a possible partner in another group
    travel once per pair of packs, and only links that span groups come back.
    Returns (id, nodes): where each row has been compared with all others."""
    dense = materialize(_mixed(flagged, links.groups), "dup-dense")
    rows = materialize(_involved(dense, sketch, threshold), "dup-involved")
    if not rows.isEmpty():
        sets = links.sets_of(rows.select("id").distinct())
        full = rows.join(dense, ["node", "id"]).join(sketch.select("id", "n", "bins"), "id").join(sets, "id")
        links.link(_spanning_links(full, links.percent))
    return materialize(dense.groupBy("id").agg(F.collect_set("node").alias("nodes")), "dup-compared")  # a few per flagged tree


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets have 100 * |A & B| >= percent * |A | B|."""
    a = sets.select(F.col("id").alias("a"), F.col("set").alias("set_a"))
    b = sets.select(F.col("id").alias("b"), F.col("set").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    j = pairs.select("a", "b").join(a, "a").join(b, "b").select(
        "a", "b", both.alias("both"), (F.size("set_a") + F.size("set_b")).cast("long").alias("sum"))
    return j.filter(100 * F.col("both") >= percent * (F.col("sum") - F.col("both"))).select("a", "b")


def _apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs that the groups found so far do not connect."""
    a = groups.select(F.col("node").alias("a"), F.col("component").alias("g_a"))
    b = groups.select(F.col("node").alias("b"), F.col("component").alias("g_b"))
    j = pairs.join(a, "a", "left").join(b, "b", "left")
    return j.filter(~F.coalesce(F.col("g_a") == F.col("g_b"), F.lit(False))).drop("g_a", "g_b")


def _candidates_only(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows (id, ...) whose id is in ``ids``, one per id. A bitmap of 2^FILTER_BITS hash
    slots, of fixed size whatever the input, goes to the readers first, so
    that most other rows are dropped before the exchange of the join."""
    slot = F.pmod(F.xxhash64("id"), F.lit(1 << FILTER_BITS)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))
    words = ids.select((slot / 64).cast("int").alias("_word"), bit.alias("_bit")).groupBy("_word").agg(
        F.bit_or("_bit").alias("_bits"))
    some = rows.join(F.broadcast(words), (slot / 64).cast("int") == F.col("_word")).filter(
        F.col("_bits").bitwiseAND(bit) != 0).drop("_word", "_bits")
    return some.dropDuplicates(["id"]).join(ids, "id")


class _Links:
    """Verified links so far and the groups they make."""

    def __init__(self, docs: DataFrame, text: str, key: str, words: int, percent: int, classes: DataFrame):
        self.docs, self.text, self.key, self.words, self.percent = docs, text, key, words, percent
        self.classes = classes
        self.groups: DataFrame | None = None

    def sets_of(self, ids: DataFrame) -> DataFrame:
        """(id, set): full sets of the classes, from their first rows' whole
        texts."""
        first = self.classes.select(F.col("class").alias("id"), F.col("first._row_key").alias("_row_key"))
        ids = materialize(ids.join(first, "id").select(F.col("_row_key").alias("id"), F.col("id").alias("class")), "dup-ids")
        rows = _candidates_only(self.docs.select(row_key(self.key, self.text).alias("id"), F.col(self.text).alias("text")), ids)
        return materialize(rows.select(F.col("class").alias("id"), shingles(F.col("text"), self.words).alias("set")), "dup-sets")

    def add(self, near: DataFrame) -> None:
        """Verify candidates (a, b, estimate): each document's best one
        first, then what stays apart."""
        near = materialize(near, "dup-near")
        if near.isEmpty():
            return
        sets = self.sets_of(near.select(F.col("a").alias("id")).union(near.select(F.col("b").alias("id"))).distinct())
        best = F.max_by(F.struct("a", "b"), F.struct("estimate", "a", "b"))
        first = (near.groupBy("a").agg(best.alias("p")).select("p.*")
                 .union(near.groupBy("b").agg(best.alias("p")).select("p.*")).distinct())
        first = materialize(first, "dup-first")
        self.link(_verified(first, sets, self.percent))
        rest = near.select("a", "b").join(first, ["a", "b"], "left_anti")
        rest = materialize(rest if self.groups is None else _apart(rest, self.groups), "dup-rest")
        if not rest.isEmpty():
            self.link(_verified(rest, sets, self.percent))

    def link(self, verified: DataFrame) -> None:
        new = materialize(verified, "dup-links")
        if new.isEmpty():
            return
        u = new.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if self.groups is not None:  # the old groups as stars
            u = u.unionByName(self.groups.select(F.col("node").alias("u"), F.col("component").alias("v")))
        self.groups = materialize(components(u), "dup-groups")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = 5, percent: int = 80,
                    trees: int = 16, small: int = 64, levels: int = 5, pivot_level: int = 2, pivot_trees: int = 4,
                    pivots: int = 3, carry: Sequence[str] = ()) -> DataFrame:
    """(key, n_shingles, component_id, kept) per row of ``docs``, plus the
    narrow columns of ``carry``."""
    with scratch(docs.sparkSession):
        answer = _near_duplicates(docs, text, key, words, percent, trees, small, levels, pivot_level, pivot_trees,
                                  pivots, carry)
        return materialize(answer, "dup-answer", keep=True)


def _near_duplicates(docs: DataFrame, text: str, key: str, words: int, percent: int, trees: int, small: int,
                     levels: int, pivot_level: int, pivot_trees: int, pivots: int, carry: Sequence[str]) -> DataFrame:
    threshold = percent / 100.0
    # Rows without a set are answered as they are.
    table = materialize(sketches(docs, text, key, words, carry), "dup-sketch")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "_row_key"))
    classes = table.filter("n > 0").groupBy("n", "digest").agg(
        first.alias("first"), F.count(F.lit(1)).alias("copies"), F.first("sketch").alias("sketch"),
        F.first("bins").alias("bins"))  # equal in the whole class
    classes = materialize(classes.withColumn("class", F.monotonically_increasing_id()), "dup-classes")
    sketch = classes.select(F.col("class").alias("id"), "n", "sketch", "bins")
    links = _Links(docs, text, key, words, percent, classes)

    tree = F.explode(F.sequence(F.lit(1), F.lit(trees)))
    level = sketch.select("id", "sketch", tree.alias("tree")).withColumn(
        "node", _flagged(F.xxhash64(F.lit("tree"), "tree"), (F.col("tree") <= pivot_trees).cast("long")))
    leaves = done = None  # rows of nodes to compare, and where rows have been compared
    for depth in range(1, levels + 1):
        rows = _shared(_children(level, 1.0 / threshold - 1.0), f"dup-level{depth}")
        few = rows.filter(F.col("count") <= small).select("node", "id")
        many = rows.filter(F.col("count") > small).select("node", "id")
        leaves = few if leaves is None else leaves.unionByName(few)
        if depth == pivot_level:
            flagged = many.filter(F.col("node").bitwiseAND(F.lit(1)) == 1)
            links.add(_pivot_pairs(flagged, sketch, pivots, threshold))
            done = _settle_dense(flagged, sketch, links, threshold)
        if depth >= pivot_level:
            many = materialize(_mixed(many, links.groups).select("node", "id"), f"dup-many{depth}")
            if many.isEmpty():
                break
        if depth == levels:
            leaves = leaves.unionByName(many)
            break
        level = many.join(sketch.select("id", "sketch"), "id")
    if done is None:
        done = sketch.select("id", F.array().cast("array<long>").alias("nodes")).limit(0)
    links.add(_node_pairs(leaves, sketch, links.groups, done, threshold))
    return _answer(table, classes, links.groups, key, carry)


def _mixed(rows: DataFrame, groups: DataFrame | None) -> DataFrame:
    """(node, id, g) of nodes that hold more than one group (a document
    without a group is one)."""
    if groups is None:
        return rows.withColumn("g", F.col("id"))
    g = groups.select(F.col("node").alias("id"), F.col("component").alias("g"))
    rows = materialize(rows.join(g, "id", "left").withColumn("g", F.coalesce("g", "id")).select("node", "id", "g"),
                       "dup-grouped")
    mixed = materialize(rows.groupBy("node").agg(F.min("g").alias("lo"), F.max("g").alias("hi"))
                        .filter("lo <> hi").select("node"), "dup-mixed-nodes")
    return rows.join(mixed, "node")


def _answer(table: DataFrame, classes: DataFrame, groups: DataFrame | None, key: str,
            carry: Sequence[str] = ()) -> DataFrame:
    """Every row's component, by the first row of its class's group."""
    c = classes.select("class", F.col("n").alias("n2"), F.col("digest").alias("d2"), "first", "copies")
    if groups is None:
        top = c.filter("copies > 1").withColumnRenamed("first", "top")
    else:
        member = c.join(groups.select(F.col("node").alias("class"), "component"), "class", "left").filter(
            "copies > 1 OR component IS NOT NULL").withColumn("component", F.coalesce("component", "class"))
        member = materialize(member, "dup-members")
        firsts = materialize(member.groupBy("component").agg(F.min("first").alias("top")), "dup-firsts")
        top = member.join(firsts, "component")
    same = (F.col("n") == F.col("n2")) & (F.col("digest") == F.col("d2"))
    rows = table.select("id", "n", "digest", "_row_key", *carry).join(top.select("n2", "d2", "top"), same, "left")
    alone = F.col("top").isNull()
    return rows.select(F.col("id").alias(key), F.col("n").alias("n_shingles"),
                       F.when(alone, F.col("id")).otherwise(F.col("top.id")).alias("component_id"),
                       (alone | (F.col("_row_key") == F.col("top._row_key"))).alias("kept"), *carry)

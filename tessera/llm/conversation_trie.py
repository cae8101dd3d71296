"""Prefix trie of conversations (operator 11).

Conversations are rebuilt (:func:`rebuilt`), turns become ids of a dictionary
of distinct (role, text) pairs, and every distinct prefix of a conversation is
a node. The trie is made in pieces that fit a task, whatever its shape:

1. *Bands.* A conversation is cut into bands of ``BAND`` turns; a band hangs
   below its *root*, the prefix before it, named by a 128-bit hash. So no
   conversation is ever held whole. Equal bands below one root are counted
   into one row first (map-side), so copies cost nothing further on.
2. *Range shards.* The distinct bands are range-sorted by (root, ids). A task
   reads its range in chunks of about ``CHUNK`` turns and puts each chunk in a
   ternary search tree, middle sequence first, then the middles of both halves
   and so on, which keeps the tree balanced. A tree node below which all is
   found by its middle pointer is a trie node. It is created after the node
   above it, so a run through the nodes backwards accumulates members, leaves
   and savings bottom-up, without recursion.
3. *Boundary nodes.* Only prefixes of a chunk's first and last sequence can
   reach into other chunks; all other nodes are complete. Boundary nodes carry
   what is complete below them and meet by a hash of their prefix: members and
   complete parts add up, and then each merged node gives its own saving, and
   a leaf if it has no child, to the boundary nodes above it.
4. *Bands meet* from the deepest up: a band's root brings its children, leaves
   and savings to the node of the band above that it continues.
5. *Ends.* The ids of the conversations that end at a node are range-sorted
   with it and joined to texts of bounded size; a last task runs these through
   SHA-256 in order, in a stream (a hash over a list is sequential by nature;
   what is sequential here is the hashing alone).

The number of Spark jobs grows with the longest conversation / ``BAND``; one
of up to 511 turns needs a single round.

Defined results: null role or text is empty; turns are ordered by turn number,
null first, then by a hash of role and text, and repeated turns count each;
rows whose conversation id is null belong to no conversation and are not read;
null turn numbers order first; very long texts are hashed and counted whole,
very long conversations run in bands; extra columns are not read, whatever
their names; an empty table has no member, hence no node, and gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import ship_package

from tessera.llm.common import give_back_memory, materialize, scratch
from tessera.llm.mixing import word_count

BAND = 512
CHUNK = 1 << 17
ENDS_CHARS = 8192
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"

NODE = T.StructType([
    T.StructField("boundary", T.BooleanType()), T.StructField("key", T.BinaryType()), T.StructField("parent", T.BinaryType()),
    T.StructField("above", T.ArrayType(T.BinaryType())), T.StructField("r1", T.LongType()), T.StructField("r2", T.LongType()),
    *[T.StructField(c, T.LongType()) for c in ("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                               "saved", "words", "e1", "e2")]])


def positions(turns: DataFrame) -> DataFrame:
    """(conv_id, digest, words, pos): each turn's number in its conversation,
    from 0. Turns are range-sorted by (conversation, order), numbered within
    their range, and ranges start where those before them end, so a
    conversation that holds a third of all rows is numbered by many tasks."""
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    dealt = turns.repartitionByRange("conv_id", *order).withColumn("range", F.spark_partition_id())
    dealt = materialize(dealt, "trie-ranges")
    counts = materialize(dealt.groupBy("conv_id", "range").count(), "trie-range-counts")
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("conv_id", "range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("conv_id", "range").orderBy(*order))
    return (dealt.withColumn("inside", inside).join(starts, ["conv_id", "range"])
            .select("conv_id", "digest", "words", (F.col("start") + F.col("inside") - 1).alias("pos")))


def rebuilt(table: DataFrame, conv: str, turn: str, role: str, text: str, block: int, most: int) -> tuple[DataFrame, DataFrame]:
    """(conv_id, length) of all rebuilt conversations, and their turns
    (conv_id, pos, digest, words): the first h original turns of the block's
    first conversation, then the conversation's own after its first h, with
    h = crc32(id) mod ``most``."""
    said = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    turns = table.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"))
    turns = materialize(turns.select("conv_id", "turn", F.unhex(F.md5(said)).alias("digest"), word_count("text").alias("words")),
                        "trie-turns")
    placed = materialize(positions(turns), "trie-positions")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    base = F.col("conv_id") - F.col("conv_id") % block
    sizes = placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    sizes = materialize(sizes.select("conv_id", "own", h.alias("h"), base.alias("base")), "trie-sizes")
    first = sizes.filter("conv_id = base").select("base", F.col("own").alias("base_own"))
    # Turns taken over: all of them if the block's first conversation has fewer, none if it is absent.
    sizes = sizes.join(first, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_own", F.lit(0))))
    sizes = materialize(sizes.select("conv_id", "base", "h", "taken",
                                     (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")),
                        "trie-lengths")
    heads = placed.filter((F.col("conv_id") == base) & (F.col("pos") < most)).withColumnRenamed("conv_id", "base")
    lead = (sizes.filter("taken > 0").select("conv_id", "base", "taken").join(heads, "base").filter("pos < taken")
            .select("conv_id", "pos", "digest", "words"))
    own = (placed.join(sizes.select("conv_id", "h", "taken"), "conv_id").filter("pos >= h")
           .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "digest", "words"))
    return sizes.select("conv_id", "length"), lead.unionByName(own)


def banded(lengths: DataFrame, turns: DataFrame, band: int) -> DataFrame:
    """(conv_id, band, last, ids, words, r1, r2, e1, e2): the bands of every
    conversation, with the hash of what comes before (r) and up to their end
    (e). A conversation whose length is a multiple of ``band`` (0 too) ends
    with an empty band."""
    distinct = materialize(turns.select("digest").distinct().withColumn("id", F.monotonically_increasing_id()), "trie-dictionary")
    coded = turns.join(distinct, "digest").select("conv_id", F.floor(F.col("pos") / band).alias("band"), "pos", "id", "words")
    parts = coded.groupBy("conv_id", "band").agg(F.array_sort(F.collect_list(F.struct("pos", "id", "words"))).alias("t"))
    parts = parts.select("conv_id", "band", F.col("t.id").alias("ids"), F.col("t.words").alias("words"))
    nothing = F.array().cast("array<long>")
    ends = lengths.select("conv_id", F.floor(F.col("length") / band).alias("last_band"), (F.col("length") % band == 0).alias("full"))
    empty = ends.filter("full").select("conv_id", F.col("last_band").alias("band"), nothing.alias("ids"), nothing.alias("words"))
    parts = materialize(parts.unionByName(empty).withColumn("h1", F.xxhash64("band", "ids")).withColumn(
        "h2", F.xxhash64(F.lit("second"), "ids", "band")), "trie-parts")
    up_to = Window.partitionBy("conv_id").orderBy("band")
    parts = parts.select("*", *[F.bit_xor(f"h{k}").over(up_to).alias(f"e{k}") for k in (1, 2)])
    return parts.join(ends, "conv_id").select(
        "conv_id", "band", (F.col("band") == F.col("last_band")).alias("last"), "ids", "words",
        *[F.col(f"e{k}").bitwiseXOR(F.col(f"h{k}")).alias(f"r{k}") for k in (1, 2)], "e1", "e2")


class TernaryTree:
    """A chunk of sorted distinct sequences below one root. Node 0 stands for
    the root; per node its symbol, the links to smaller and larger symbols at
    the same place and to the next place, and its trie node's numbers."""

    def __init__(self):
        self.symbol, self.low, self.next, self.high, self.above, self.depth = [0], [-1], [-1], [-1], [-1], [0]
        self.members, self.least, self.words = [0], [None], [0]
        # Of the bands below: children, leaves, savings; and the hash of conversations that end here.
        self.children, self.leaves, self.saved, self.ends = [0], [0], [0], [None]

    def _new(self, symbol: int, above: int, words: int) -> int:
        for column, value in ((self.symbol, symbol), (self.low, -1), (self.next, -1), (self.high, -1), (self.above, above),
                              (self.depth, self.depth[above] + 1), (self.members, 0), (self.least, None), (self.words, words),
                              (self.children, 0), (self.leaves, 0), (self.saved, 0), (self.ends, None)):
            column.append(value)
        return len(self.symbol) - 1

    def path(self, ids, words=None) -> list[int]:
        """Nodes of a sequence's prefixes, from the root; missing ones are
        made if ``words`` are given."""
        symbol, low, high, following = self.symbol, self.low, self.high, self.next
        at, out = 0, [0]
        for k, s in enumerate(ids):
            x, link, source = following[at], following, at
            while x >= 0 and symbol[x] != s:
                link = low if s < symbol[x] else high
                source, x = x, link[x]
            if x < 0:
                x = self._new(s, at, words[k])
                link[source] = x
            at = x
            out.append(at)
        return out

    def insert_all(self, rows) -> None:
        """Sorted rows (ids, words, members, least, below, ends), medians
        first."""
        spans = [(0, len(rows))]
        while spans:
            lo, hi = spans.pop()
            if lo < hi:
                mid = (lo + hi) // 2
                ids, words, members, least, below, ends = rows[mid]
                at = self.path(ids, words)[-1]
                self.members[at] += members
                self.least[at] = least
                self.ends[at] = ends
                if below and below[0]:
                    self.children[at], self.leaves[at], self.saved[at] = below
                spans += [(lo, mid), (mid + 1, hi)]

    def accumulate(self, boundary: set[int]) -> None:
        """Bottom-up: members and least ids into all nodes; children, leaves
        and savings of complete nodes into those above."""
        members, least, above = self.members, self.least, self.above
        for x in range(len(members) - 1, 0, -1):
            up = above[x]
            members[up] += members[x]
            if least[up] is None or least[x] < least[up]:
                least[up] = least[x]
            if x in boundary:  # its own part comes with the merged node
                self.leaves[up] += self.leaves[x]
                self.saved[up] += self.saved[x]
                continue
            if not self.children[x]:
                self.leaves[x] = 1
            self.saved[x] += (members[x] - 1) * self.words[x]
            self.children[up] += 1
            self.leaves[up] += self.leaves[x]
            self.saved[up] += self.saved[x]


def chunk_rows(rows, root: tuple[int, int], band: int, width: int = BAND) -> dict[str, list]:
    """The columns of ``NODE`` for a chunk of sorted rows below ``root``."""
    import hashlib
    import struct
    tree = TernaryTree()
    tree.insert_all(rows)
    keys: dict[int, bytes] = {}
    above: dict[int, list[bytes]] = {}
    for ids in (rows[0][0], rows[-1][0]):
        h = hashlib.blake2b(struct.pack("<qqq", band, *root), digest_size=16)
        path = tree.path(ids)
        for k, x in enumerate(path):
            if k:
                h.update(struct.pack("<q", ids[k - 1]))
            if x not in keys:
                keys[x] = h.copy().digest()
                above[x] = [keys[y] for y in path[:k]]
    tree.accumulate(set(keys))
    out: dict[str, list] = {f.name: [] for f in NODE.fields}
    for x in range(len(tree.symbol)):
        edge, up = x in keys, tree.above[x]
        ends = tree.ends[x] or (None, None)
        for name, value in (
                ("boundary", edge), ("key", keys.get(x)), ("parent", keys.get(up)), ("above", above.get(x)),
                ("r1", root[0]), ("r2", root[1]), ("depth", band * width + tree.depth[x]), ("conv_id", tree.least[x]),
                ("parent_conv_id", tree.least[up] if up >= 0 and up not in keys else None), ("n_convs", tree.members[x]),
                ("n_children", tree.children[x]), ("n_leaves", tree.leaves[x]), ("saved", tree.saved[x]),
                ("words", tree.words[x]), ("e1", ends[0]), ("e2", ends[1])):
            out[name].append(value)
    return out


def shard_nodes(rows: DataFrame, band: int, width: int, chunk: int) -> DataFrame:
    """``NODE`` rows from the distinct bands (r1, r2, ids, words, members,
    least, c, l, s, e1, e2) of one depth."""
    ship_package()
    ranged = rows.repartitionByRange("r1", "r2", "ids").sortWithinPartitions("r1", "r2", "ids")

    def run(batches):
        import pyarrow as pa
        types = [pa.bool_(), pa.binary(), pa.binary(), pa.list_(pa.binary()), *[pa.int64()] * 12]

        def made(held, root):
            out = chunk_rows(held, root, band, width)
            n = len(out["depth"])
            for lo in range(0, n, 1 << 16):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v[lo:lo + (1 << 16)], t) for v, t in zip(out.values(), types)], names=list(out))

        held: list = []
        root, size = None, 0
        for b in batches:
            for r1, r2, ids, words, members, least, c, l, s, e1, e2 in zip(*[x.to_pylist() for x in b.columns]):
                if held and (size >= chunk or root != (r1, r2)):
                    yield from made(held, root)
                    held, size = [], 0
                root = (r1, r2)
                held.append((ids, words, members, least, (c, l, s), None if e1 is None else (e1, e2)))
                size += len(ids) + 1
        if held:
            yield from made(held, root)
        give_back_memory()

    columns = ("r1", "r2", "ids", "words", "members", "least", "c", "l", "s", "e1", "e2")
    return ranged.select(*columns).mapInArrow(run, NODE)


def merged_boundary(nodes: DataFrame) -> DataFrame:
    """Boundary nodes of all chunks, one row per prefix, with whole numbers."""
    parts = nodes.filter("boundary").groupBy("key").agg(
        *[F.max(c).alias(c) for c in ("parent", "above", "r1", "r2", "depth", "words", "e1", "e2")], F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")])
    parts = materialize(parts, "trie-boundary")
    inner = materialize(parts.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(
        F.count(F.lit(1)).alias("inner")), "trie-boundary-children")
    parts = parts.join(inner, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("inner", F.lit(0)))
    parts = materialize(parts.drop("inner"), "trie-boundary-counted")
    own = parts.select(F.explode(F.concat("above", F.array("key"))).alias("key"),
                       ((F.col("n_convs") - 1) * F.col("words")).alias("own_saved"),
                       (F.col("n_children") == 0).cast("long").alias("own_leaf"))
    own = own.groupBy("key").agg(F.sum("own_saved").alias("own_saved"), F.sum("own_leaf").alias("own_leaf"))
    whole = parts.join(materialize(own, "trie-boundary-own"), "key")
    return materialize(whole.withColumn("n_leaves", F.col("n_leaves") + F.col("own_leaf")).withColumn(
        "saved", F.col("saved") + F.col("own_saved")), "trie-boundary-whole")


def ends_hashes(bands: DataFrame) -> DataFrame:
    """(e1, e2, ends_sha256) of the conversations that end at a node."""
    schema = T.StructType([T.StructField("e1", T.LongType()), T.StructField("e2", T.LongType()),
                           T.StructField("conv_id", T.LongType()), T.StructField("text", T.StringType())])

    def join(batches):
        import pyarrow as pa
        group, first, parts, size = None, None, [], 0
        for b in batches:
            out = []
            for e1, e2, c in zip(*[x.to_pylist() for x in b.columns]):
                if parts and (group != (e1, e2) or size >= ENDS_CHARS):
                    out.append((*group, first, ",".join(parts)))
                    parts, size = [], 0
                if not parts:
                    group, first = (e1, e2), c
                parts.append(str(c))
                size += len(parts[-1]) + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (
                    pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=schema.names)
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*group, first, ",".join(parts)), (
                pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=schema.names)

    def digest(batches):
        import hashlib
        import pyarrow as pa
        group, h = None, None
        for b in batches:
            out = []
            for e1, e2, _, text in zip(*[x.to_pylist() for x in b.columns]):
                if group == (e1, e2):
                    h.update(b"," + text.encode())
                else:
                    if h is not None:
                        out.append((*group, h.hexdigest()))
                    group, h = (e1, e2), hashlib.sha256(text.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=["e1", "e2", "ends_sha256"])
        if h is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*group, h.hexdigest())], names=["e1", "e2", "ends_sha256"])

    order = ("e1", "e2", "conv_id")
    ids = bands.filter("last").select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    texts = ids.mapInArrow(join, schema)
    return texts.repartition("e1", "e2").sortWithinPartitions(*order).mapInArrow(digest, "e1 long, e2 long, ends_sha256 string")


def _parent(nodes: DataFrame, boundary: DataFrame) -> DataFrame:
    """``nodes`` with the id of the parent that is a boundary node."""
    ids = boundary.select(F.col("key").alias("parent"), F.col("conv_id").alias("_up"))
    inside = nodes.filter("parent IS NULL")
    below = nodes.filter("parent IS NOT NULL").join(ids, "parent").withColumn("parent_conv_id", F.col("_up")).drop("_up")
    return inside.unionByName(below)


def conversation_trie(table: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                      block: int = 20, most: int = 4, band: int = BAND, chunk: int = CHUNK) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    with scratch(table.sparkSession):
        return materialize(_trie(table, conv, turn, role, text, block, most, band, chunk), "trie-answer", keep=True)


def _trie(table: DataFrame, conv: str, turn: str, role: str, text: str, block: int, most: int, band: int,
          chunk: int) -> DataFrame:
    lengths, turns = rebuilt(table, conv, turn, role, text, block, most)
    bands = materialize(banded(lengths, turns, band), "trie-bands")
    ends = materialize(ends_hashes(bands), "trie-ends")
    distinct = materialize(bands.groupBy("band", "r1", "r2", "e1", "e2", "ids", "words").agg(
        F.count(F.lit(1)).alias("members"), F.min("conv_id").alias("least"), F.max("last").alias("last")), "trie-distinct")
    deepest = distinct.agg(F.max("band")).first()[0]
    answer, below = None, None
    for b in range(-1 if deepest is None else deepest, -1, -1):
        rows = distinct.filter(F.col("band") == b)
        ending = [F.when(F.col("last"), F.col(e)).alias(e) for e in ("e1", "e2")]
        plain = ["r1", "r2", "ids", "words", "members", "least"]
        none = [F.lit(0).cast("long").alias(c) for c in ("c", "l", "s")]
        ready = rows.filter("last").select(*plain, *none, *ending)
        if below is not None:
            ready = ready.unionByName(rows.filter("NOT last").join(below, ["e1", "e2"]).select(
                *plain, "c", "l", "s", F.col("f1").alias("e1"), F.col("f2").alias("e2")))
        nodes = materialize(shard_nodes(ready, b, band, chunk), "trie-nodes")
        boundary = merged_boundary(nodes)
        if b:
            below = boundary.filter(F.col("depth") == b * band).select(
                F.col("r1").alias("e1"), F.col("r2").alias("e2"), F.col("n_children").alias("c"), F.col("n_leaves").alias("l"),
                F.col("saved").alias("s"), F.col("e1").alias("f1"), F.col("e2").alias("f2"))
        columns = ["parent", "parent_conv_id", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved", "e1", "e2"]
        top = boundary.withColumn("parent_conv_id", F.lit(None).cast("long"))
        if b:  # the root of a deeper band is a node of the band above
            top = top.filter(F.col("depth") > b * band)
        part = _parent(nodes.filter("NOT boundary").select(*columns).unionByName(top.select(*columns)), boundary)
        answer = part if answer is None else answer.unionByName(part)
    fields = [*[F.col(c).alias(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves")],
              F.col("saved").alias("saved_tokens")]
    if answer is None:
        return table.sparkSession.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, "
                                                  "n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    answer = materialize(answer, "trie-all")
    here = answer.filter("e1 IS NOT NULL").join(ends, ["e1", "e2"]).select(*fields, "ends_sha256")
    return here.unionByName(answer.filter("e1 IS NULL").select(*fields, F.lit(EMPTY_SHA256).alias("ends_sha256")))

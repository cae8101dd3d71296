"""Edge-list operators and triangle counting.

Edges are rows ``(src, dst)``. The reference counts triangles by joining the
symmetric edge list with itself on the middle node (all ordered pairs of a
node's neighbours) and dividing the closed paths by 6. That enumeration is
quadratic in a hub's degree: a node holding a third of all edges would put
(m/3)^2 rows behind one key. Here every undirected edge is oriented from the
endpoint lower in (degree, id) order to the higher one; a node then has at
most sqrt(2m) out-neighbours, every triangle is found exactly once, and the
total work is O(m^1.5) (the published NodeIterator++ scheme). The reference's
six-fold listing is produced from that single find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.joins import SLICE_PAIRS, skew_safe_join, skew_safe_pairs
from tessera.session import cut_lineage

# Words of the bitmap of edges, as a power of two: 2^20 words of 64 bits.
WORD_BITS = 20


def drop_self_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Edges whose ends differ (null ends are dropped as well)."""
    return edges.filter(F.col(src) != F.col(dst))


def symmetric_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Each edge in both directions, without duplicates: one narrow
    ``inline`` and one ``distinct`` (whose partial step removes repeats of a
    hot edge inside each task)."""
    a, b = F.col(src), F.col(dst)
    both = F.array(F.struct(a.alias("src"), b.alias("dst")),
                   F.struct(b.alias("src"), a.alias("dst")))
    return edges.select(F.inline(both)).distinct()


def undirected_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Distinct unordered edges ``(u, v)`` with ``u < v``; self-edges gone."""
    a, b = F.col(src), F.col(dst)
    return (drop_self_edges(edges, src, dst)
            .select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))
            .distinct())


def degrees(und: DataFrame) -> DataFrame:
    """(node, deg) of an undirected edge set from :func:`undirected_edges`."""
    ends = und.select(F.explode(F.array("u", "v")).alias("node"))
    return ends.groupBy("node").agg(F.count(F.lit(1)).alias("deg"))


def _before(d1: Column, n1: Column, d2: Column, n2: Column) -> Column:
    """(d1, n1) < (d2, n2) in (degree, id) order."""
    return (d1 < d2) | ((d1 == d2) & (n1 < n2))


def oriented_edges(edges: DataFrame, src: str = "src", dst: str = "dst",
                   checkpoint: bool = False) -> DataFrame:
    """(src, dst, dst_deg): each undirected edge once, pointing from the end
    lower in (degree, id) order to the higher one.

    Degrees attach through two lookup joins on the node id. A hub's edges
    would all meet its single degree row in one task, so the joins leave AQE
    free to split them (:func:`tessera.operators.joins.skew_safe_join`).

    With ``checkpoint``, the distinct undirected edges and the result are
    each written once to the session's checkpoint folder (two jobs run when
    this is called): the raw edge input is then read once (not once per
    use), the result can feed several joins without replaying the
    preparation, and a lost executor does not replay it either.
    """
    und = undirected_edges(edges, src, dst)
    if checkpoint:
        und = cut_lineage(und)
    deg = degrees(und)
    e = skew_safe_join(und, deg.select(F.col("node").alias("u"), F.col("deg").alias("du")), ["u"])
    e = skew_safe_join(e, deg.select(F.col("node").alias("v"), F.col("deg").alias("dv")), ["v"])
    fwd = _before(F.col("du"), F.col("u"), F.col("dv"), F.col("v"))
    out = e.select(
        F.when(fwd, F.col("u")).otherwise(F.col("v")).alias("src"),
        F.when(fwd, F.col("v")).otherwise(F.col("u")).alias("dst"),
        F.when(fwd, F.col("dv")).otherwise(F.col("du")).alias("dst_deg"),
    )
    return cut_lineage(out) if checkpoint else out


def two_paths(oriented: DataFrame, slice_pairs: int = SLICE_PAIRS) -> DataFrame:
    """(middle, start, end): two out-neighbours of ``middle`` in an oriented
    edge set, ``start`` before ``end`` in (degree, id) order.

    This is our bounded form of the reference's two-path join: each
    candidate triangle corner appears once, and no node pairs more than
    sqrt(2m) neighbours. Such a node may still form about m pairs, which
    AQE cannot see from input sizes, so the join is salted for nodes whose
    pairs exceed ``slice_pairs`` (:func:`tessera.operators.joins.skew_safe_pairs`).
    """
    a = oriented.select(F.col("src").alias("middle"), F.col("dst").alias("start"),
                        F.col("dst_deg").alias("ds"))
    b = oriented.select(F.col("src").alias("middle"), F.col("dst").alias("end"),
                        F.col("dst_deg").alias("de"))
    pairs = skew_safe_pairs(a, b, "middle", "start", slice_pairs=slice_pairs)
    return (pairs
            .filter(_before(F.col("ds"), F.col("start"), F.col("de"), F.col("end")))
            .select("middle", "start", "end"))


def closing_edges(edges: DataFrame, paths: DataFrame, src: str = "src",
                  dst: str = "dst", edges_distinct: bool = False) -> DataFrame:
    """(start, end, middle) for every path whose ends are joined by an edge:
    an equi-join of the paths with the distinct edge set on both ends.
    ``edges_distinct`` skips the de-duplication (and its shuffle) for an
    edge set that is distinct by construction."""
    e = edges.select(F.col(src).alias("start"), F.col(dst).alias("end"))
    if not edges_distinct:
        e = e.distinct()
    return paths.join(e, ["start", "end"], "left_semi").select("start", "end", "middle")


def closable_paths(paths: DataFrame, oriented: DataFrame, word_bits: int = WORD_BITS) -> DataFrame:
    """Those two-paths whose ends an edge may join: a filter in front of
    :func:`closing_edges` that drops most open paths where they are formed,
    before any exchange, and never a closed one.

    The ends of every oriented edge set one of ``2 ** (word_bits + 6)`` bits,
    kept as 64-bit words: at most ``2 ** word_bits`` rows of two longs,
    whatever the graph, so they are broadcast. A path stays where its ends'
    bit is set. With many more edges than bits all paths stay, for the price
    of one lookup each; a larger graph wants a larger ``word_bits``. Paths
    and edges must come from the same oriented edge set (hashes of equal
    numbers of different types differ).
    """
    def slot(a: str, b: str) -> tuple[Column, Column]:
        h = F.xxhash64(a, b)
        return F.shiftrightunsigned(h, 64 - word_bits), h.bitwiseAND(F.lit(63)).cast("int")

    word, bit = slot("src", "dst")
    words = (oriented.select(word.alias("_word"), F.expr("1L").alias("_one"), bit.alias("_bit"))
             .groupBy("_word").agg(F.bit_or(F.expr("shiftleft(_one, _bit)")).alias("_bits")))
    word, bit = slot("start", "end")
    return (paths.withColumn("_word", word).withColumn("_bit", bit)
            .join(F.broadcast(words), "_word")
            .filter(F.expr("shiftrightunsigned(_bits, _bit) & 1L = 1L"))
            .select(*paths.columns))


def triangles(edges: DataFrame, src: str = "src", dst: str = "dst",
              checkpoint: bool = True, slice_pairs: int = SLICE_PAIRS,
              word_bits: int = WORD_BITS) -> DataFrame:
    """(a, b, c): every triangle once, ``a`` first in (degree, id) order.

    The oriented edge set feeds four inputs (both sides of the two-path
    join, the bitmap of :func:`closable_paths` and the closing semi-join);
    with ``checkpoint`` it is materialised once (see :func:`oriented_edges`).
    """
    o = oriented_edges(edges, src, dst, checkpoint)
    paths = closable_paths(two_paths(o, slice_pairs), o, word_bits)
    closed = closing_edges(o, paths, edges_distinct=True)
    return closed.select(F.col("middle").alias("a"), F.col("start").alias("b"),
                         F.col("end").alias("c"))


def triangle_paths(edges: DataFrame, src: str = "src", dst: str = "dst",
                   checkpoint: bool = True) -> DataFrame:
    """(start, end, middle) for every two-path of the symmetric, self-edge-free
    graph that an edge closes: the reference's closed-path listing, six rows
    per triangle, produced from the single find of :func:`triangles`."""
    t = triangles(edges, src, dst, checkpoint)
    a, b, c = F.col("a"), F.col("b"), F.col("c")

    def row(s: Column, e: Column, m: Column) -> Column:
        return F.struct(s.alias("start"), e.alias("end"), m.alias("middle"))

    six = F.array(row(b, c, a), row(c, b, a), row(a, c, b),
                  row(c, a, b), row(a, b, c), row(b, a, c))
    return t.select(F.inline(six))


def triangle_count(edges: DataFrame, src: str = "src", dst: str = "dst",
                   checkpoint: bool = True) -> DataFrame:
    """One row ``(triangles long)``: self-edges and duplicates removed first,
    each triangle counted once (no division by 6 needed)."""
    return triangles(edges, src, dst, checkpoint).agg(F.count(F.lit(1)).alias("triangles"))


"""Resharding by minimum-cost flow (operator 2).

From the byte sizes of the old shards and the capacities of the new ones, a
transportation problem gives how many bytes go from each old to each new
shard: a byte that stays in its shard costs nothing, a byte that moves costs
one. Its solution is realised by whole *blocks* (rows of equal text hash
range), so copies of one text stay together. A block larger than a whole
shard is divided by a second hash of the text; only a text that alone holds
more than a shard's share is divided by its rows, and no other with it.
Affected shards can then be rewritten (:func:`rewrite_layout`).

The flow has (old x new) arcs and the block table at most ``blocks`` rows
(plus the parts of divided blocks), whatever the number of documents; both
are solved on the driver. Rows are numbered within their shard by hash
buckets, so no task ever holds a whole shard.

Defined results: a null text has size 1 and the CRC of the empty text; an
empty text likewise; repeated rows are placed each, all in one shard unless
their text alone exceeds a shard; ids may be null or repeat; very long texts
are hashed and counted whole; extra columns, whatever their names, are not
read by :func:`reshard` and kept by :func:`rewrite_layout`; an empty table
gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections import deque
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize, number_rows, packed, unpacked, utf8_bytes, utf8_crc32


def min_cost_flow(supply: Sequence[int], capacity: Sequence[int]) -> list[list[int]]:
    """Bytes to send from each old shard to each new one, all supply placed
    and the fewest bytes moved: successive shortest augmenting paths in the
    residual graph of the transportation problem (cost 0 when the numbers
    agree, else 1). ``sum(capacity) >= sum(supply)`` is required."""
    if sum(capacity) < sum(supply):
        raise ValueError("new capacities are below the bytes to place")
    n, m = len(supply), len(capacity)
    flow = [[0] * m for _ in range(n)]
    left, free = list(supply), list(capacity)

    def cost(i: int, j: int) -> int:
        return 0 if i == j else 1

    while any(left):
        # Label-correcting search from every old shard with bytes left.
        dist = {("o", i): 0 for i in range(n) if left[i]}
        parent: dict = {}
        queue = deque(dist)
        while queue:
            kind, a = queue.popleft()
            if kind == "o":
                steps = [(("n", j), cost(a, j)) for j in range(m)]
            else:
                steps = [(("o", i), -cost(i, a)) for i in range(n) if flow[i][a]]
            for node, c in steps:
                d = dist[(kind, a)] + c
                if d < dist.get(node, 1 << 60):
                    dist[node], parent[node] = d, (kind, a)
                    queue.append(node)
        end = min((("n", j) for j in range(m) if free[j]), key=lambda x: (dist[x], x[1]))
        path = [end]
        while path[-1] in parent:
            path.append(parent[path[-1]])
        path.reverse()
        amount = min(left[path[0][1]], free[end[1]])
        for (ka, a), (_, b) in zip(path, path[1:]):
            if ka == "n":
                amount = min(amount, flow[b][a])
        for (ka, a), (_, b) in zip(path, path[1:]):
            if ka == "o":
                flow[a][b] += amount
            else:
                flow[b][a] -= amount
        left[path[0][1]] -= amount
        free[end[1]] -= amount
    return flow


def assign_blocks(blocks: Sequence[tuple[int, int]], flow: Sequence[Sequence[int]],
                  capacity: Sequence[int]) -> list[int]:
    """New shard of each block, given (old shard, bytes) per block.

    Per old shard, blocks go by falling size to the arc that still takes
    them whole, staying first, else to the arc with most room. Whole blocks
    leave shards a little over or under; a last pass moves the largest block
    that fits from the fullest shard to the emptiest while that helps.
    """
    n_new = len(capacity)
    room = [list(r) for r in flow]
    shard = [0] * len(blocks)
    held = [0] * n_new
    order = sorted(range(len(blocks)), key=lambda k: (-blocks[k][1], k))
    for k in order:
        old, size = blocks[k]
        fits = [j for j in range(n_new) if room[old][j] >= size]
        if old in fits:
            j = old
        else:
            j = max(fits or range(n_new), key=lambda x: (room[old][x], -x))
        room[old][j] -= size
        shard[k] = j
        held[j] += size

    mine: list[list[tuple[int, int]]] = [[] for _ in range(n_new)]
    for k in reversed(order):
        mine[shard[k]].append((blocks[k][1], k))
    for _ in range(4 * len(blocks)):
        over = max(range(n_new), key=lambda j: (held[j] - capacity[j], -j))
        under = min(range(n_new), key=lambda j: (held[j] - capacity[j], j))
        gap = (held[over] - capacity[over]) - (held[under] - capacity[under])
        # A block below the gap makes the two closer; half the gap is best.
        at = bisect_right(mine[over], (gap // 2, len(blocks)))
        near = [i for i in (at - 1, at) if 0 <= i < len(mine[over]) and 0 < mine[over][i][0] < gap]
        if not near:
            break
        best = min(near, key=lambda i: (abs(2 * mine[over][i][0] - gap), i))
        size, k = mine[over].pop(best)
        insort(mine[under], (size, k))
        shard[k] = under
        held[over] -= size
        held[under] += size
    return shard


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


@dataclass(frozen=True)
class ReshardPlan:
    """Where each block (part -1) or part of a divided block was and goes:
    (block, part, old shard, new shard). Parts below ``parts`` hold whole
    texts, by a second hash; those from ``parts`` on hold rows of the texts in
    ``hot`` (text hashes)."""

    moves: tuple[tuple[int, int, int, int], ...]
    blocks: int
    parts: int
    hot: tuple[int, ...] = ()

    @property
    def divided(self) -> list[int]:
        return sorted({b for b, p, _, _ in self.moves if p >= 0})

    @property
    def affected(self) -> list[int]:
        """Shards whose content changes."""
        return sorted({x for _, _, old, new in self.moves if old != new for x in (old, new)})


def unit_columns(text: str, key: str, blocks: int) -> tuple[Column, Column, Column]:
    """A row's block (by its text), its text's hash, and the hash that deals
    the rows of a hot text."""
    h = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    return F.pmod(h, F.lit(blocks)).cast("int"), h, F.xxhash64(F.col(key), h, F.lit("row"))


def part_column(divided: Sequence[int], hot: Sequence[int], parts: int, block: Column, text_hash: Column, key: Column) -> Column:
    """A row's part of its block, -1 in blocks that stay whole."""
    if not divided:
        return F.lit(-1)
    by_text = F.pmod(F.xxhash64(text_hash, F.lit("part")), F.lit(parts))
    if hot:
        by_text = F.when(text_hash.isin(list(hot)), F.pmod(key, F.lit(parts)) + parts).otherwise(by_text)
    return F.when(block.isin(list(divided)), by_text).otherwise(-1).cast("int")


def plan_moves(rows: DataFrame, new_shards: int, old_shards: int, blocks: int,
               parts: int = 64, capacities: Sequence[int] | None = None) -> ReshardPlan:
    """The plan for rows with ``block``, ``text_hash``, ``key`` and ``size``.
    The driver gets one row per block, up to 2 * ``parts`` rows per divided
    block, and the hash of each text above a shard's share (fewer than
    shards)."""
    sizes = {r["block"]: r["bytes"] for r in
             rows.groupBy("block").agg(F.sum("size").alias("bytes")).collect()}  # at most `blocks` rows
    capacity = list(capacities) if capacities else equal_capacities(sum(sizes.values()), new_shards)
    large = sorted(b for b, s in sizes.items() if s > min(capacity))  # few: each holds a shard's bytes
    units = [(b, -1, s) for b, s in sizes.items() if b not in set(large)]
    hot: tuple[int, ...] = ()
    if large:
        inside = rows.filter(F.col("block").isin(large))
        most = inside.groupBy("text_hash").agg(F.sum("size").alias("bytes")).filter(F.col("bytes") > min(capacity))
        hot = tuple(sorted(r["text_hash"] for r in most.collect()))
        part = part_column(large, hot, parts, F.col("block"), F.col("text_hash"), F.col("key"))
        divided = inside.groupBy("block", part.alias("part")).agg(F.sum("size").alias("bytes"))
        units += [(r["block"], r["part"], r["bytes"]) for r in divided.collect()]
    units.sort()
    old = [b * old_shards // blocks for b, _, _ in units]
    supply = [0] * old_shards
    for o, (_, _, s) in zip(old, units):
        supply[o] += s
    flow = min_cost_flow(supply, capacity)
    new = assign_blocks([(o, s) for o, (_, _, s) in zip(old, units)], flow, capacity)
    return ReshardPlan(tuple((b, p, o, j) for (b, p, _), o, j in zip(units, old, new)), blocks, parts, hot)


def with_shards(rows: DataFrame, plan: ReshardPlan, block: Column, text_hash: Column, key: Column) -> DataFrame:
    """``rows`` plus ``old_shard`` and ``shard``, by a broadcast of the plan
    (bounded: one row per block or part of a divided block)."""
    table = rows.sparkSession.createDataFrame(list(plan.moves), "_block int, _part int, old_shard int, shard int")
    part = part_column(plan.divided, plan.hot, plan.parts, block, text_hash, key)
    where = rows.join(F.broadcast(table), (block == F.col("_block")) & (part == F.col("_part")))
    return where.drop("_block", "_part")


def reshard(docs: DataFrame, new_shards: int = 8, old_shards: int = 6, text: str = "text", key: str = "doc_id",
            blocks: int = 8192, parts: int = 64,
            capacities: Sequence[int] | None = None) -> tuple[DataFrame, ReshardPlan]:
    """(key, size, text_crc32, old_shard, shard, slot) per row, and the plan.
    The old layout deals ranges of the text hash to ``old_shards`` parts; the
    new shards get equal shares of all bytes, or ``capacities``."""
    block, text_hash, row_hash = unit_columns(text, key, blocks)
    rows = materialize(docs.select(
        F.col(key).alias("doc_id"), (utf8_bytes(text) + 1).alias("size"), utf8_crc32(text).alias("text_crc32"),
        block.alias("block"), text_hash.alias("text_hash"), row_hash.alias("key")), "reshard-rows")
    plan = plan_moves(rows, new_shards, old_shards, blocks, parts, capacities)
    placed = with_shards(rows, plan, F.col("block"), F.col("text_hash"), F.col("key"))
    placed = placed.select("doc_id", "size", "text_crc32", "old_shard", "shard")
    out = number_rows(placed, ["shard"], ["doc_id", "text_crc32", "size"], "slot")
    return out.select(F.col("doc_id").alias(key), "size", "text_crc32", "old_shard", "shard", "slot"), plan


def rewrite_layout(docs: DataFrame, plan: ReshardPlan, out_dir: str, text: str = "text", key: str = "doc_id",
                   files_per_shard: int = 8) -> list[int]:
    """Write the shards whose content changes under ``out_dir/shard=N`` (all
    columns of ``docs``; ``shard_=N`` where ``docs`` has a ``shard``) and
    return their numbers. A shard that keeps exactly its rows is left out:
    its old files stay valid. A row's shard follows from the row, so nothing
    is joined but the plan."""
    name = "shard"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    block, text_hash, unit = unit_columns(text, key, plan.blocks)
    rows = packed(docs, block.alias("block"), text_hash.alias("text_hash"), unit.alias("unit"))
    rows = with_shards(rows, plan, F.col("block"), F.col("text_hash"), F.col("unit"))
    rows = rows.filter(F.col("shard").isin(plan.affected))
    n = max(1, len(plan.affected)) * files_per_shard
    (rows.repartition(n, "shard", F.pmod(F.col("unit"), F.lit(files_per_shard)))
     .select(*unpacked(docs.columns), F.col("shard").alias(name)).write.partitionBy(name).parquet(out_dir))
    return plan.affected

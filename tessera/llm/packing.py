"""Pattern packing by non-negative least squares (operator 4).

Texts are tokenized, closed with an end id and cut into pieces of at most
``capacity`` tokens (a longer text's first piece takes the remainder, the
others are full). From then on only the histogram of piece lengths counts:

1. *Patterns* of at most three lengths that fill a sequence exactly are
   enumerated.
2. Non-negative least squares fits repeat counts to the histogram: an
   active-set method that adds the patterns with the largest gradient,
   solves the normal equations on the active ones and steps back where a
   count would turn negative.
3. Counts are rounded down, and the lengths left over are packed best-fit
   by falling length, again on counts: equal bins are handled together.
4. Patterns may have used up the partners that the pieces left over would
   need. A repair gives repeats back to the residual: each pattern keeps one
   share of its repeats, the largest of ``KEPT`` with which the fewest
   sequences are needed, and then single patterns give theirs back while that
   saves a sequence. With nothing kept the plan would be best-fit alone, so it
   never needs more sequences than that.

The plan has a bounded size (at most a few patterns per length), whatever
the number of pieces, and is solved on the driver. Each piece then finds its
place from its number within its length, which hash buckets provide, so no
task holds all pieces of one length.

Defined results: a null or empty text is one piece holding the end id; a
text without spaces is tokenized whole, very long texts in parts cut at safe
spaces; repeated rows are packed each; ties between plans go to the one that
keeps more patterns; extra columns, whatever their names, are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import ship_package

from tessera.llm.common import give_back_memory, materialize, number_rows, tokenizer_path, worker_state
from tessera.llm.segments import HfSegments
from tessera.llm.token_counts import slices_by_bytes

# A group of equal sequences: [(length, how many of it per sequence), ...]
# in falling order, and the number of such sequences.
Group = tuple[list[tuple[int, int]], int]
KEPT = (1.0, 0.99, 0.97, 0.95, 0.9, 0.8, 0.65, 0.5, 0.35, 0.2, 0.1, 0.05, 0.0)


def piece_starts(n: int, capacity: int) -> list[int]:
    """Start of each piece of a text of ``n`` tokens."""
    first = n % capacity or capacity
    return [0, *range(first, n, capacity)] if n > capacity else [0]


def patterns_of(lengths, capacity: int):
    """(patterns x 3) lengths in falling order (0: unused), all drawn from
    ``lengths`` and filling ``capacity`` exactly."""
    import numpy as np
    have = np.zeros(capacity + 1, bool)
    have[list(lengths)] = True
    out = [(capacity, 0, 0)] if have[capacity] else []
    for a in range(capacity - 1, 0, -1):
        if not have[a]:
            continue
        rest = capacity - a
        if rest <= a and have[rest]:
            out.append((a, rest, 0))
        b = np.arange(min(a, rest - 1), (rest + 1) // 2 - 1, -1)
        b = b[(b > 0) & have[b] & have[rest - b] & (rest - b > 0)]
        out += [(a, int(x), rest - int(x)) for x in b]
    return np.array(out, np.int64).reshape(-1, 3)


def fit_counts(patterns, histogram, add: int = 48, rounds: int = 60, tolerance: float = 1e-3):
    """Non-negative repeat counts with the least squared difference to the
    histogram (index: length; index 0 unused)."""
    import numpy as np
    rows = len(histogram)
    target = histogram.astype(np.float64).copy()
    target[0] = 0.0
    counts = np.zeros(len(patterns))
    active = np.empty(0, np.int64)

    def covered(x, which):
        y = np.zeros(rows)
        for j in range(3):
            y += np.bincount(patterns[which, j], x, rows)
        y[0] = 0.0
        return y

    def solve(which):
        a = np.zeros((rows, len(which)))
        for j in range(3):
            np.add.at(a, (patterns[which, j], np.arange(len(which))), 1.0)
        a[0] = 0.0
        return np.linalg.solve(a.T @ a + 1e-7 * np.eye(len(which)), a.T @ target)

    goal = tolerance * max(1.0, float(target.max()))
    last = np.inf
    for _ in range(rounds):
        left = target - covered(counts[active], active)
        error = float(left @ left)
        if error >= last * (1 - 1e-4):
            break
        last = error
        left[0] = 0.0
        gradient = left[patterns].sum(axis=1)
        gradient[active] = -np.inf
        order = np.argsort(-gradient)[:8 * add]
        order = order[gradient[order] > goal]
        taken, fresh = set(), []
        for p in order.tolist():  # patterns that share no length move freely
            mine = set(patterns[p].tolist()) - {0}
            if not mine & taken:
                taken |= mine
                fresh.append(p)
            if len(fresh) == add:
                break
        if not fresh:
            break
        active = np.concatenate([active, np.array(fresh, np.int64)])
        while len(active):
            x = solve(active)
            if x.min() > 0:
                counts[active] = x
                break
            down = x <= 0
            now = counts[active]
            step = float(np.min(now[down] / np.maximum(now[down] - x[down], 1e-12)))
            counts[active] = now + step * (x - now)
            gone = down & (counts[active] <= 1e-9)
            if not gone.any():  # the step is exact up to rounding: drop the lowest
                gone[np.argmin(np.where(down, counts[active], np.inf))] = True
            counts[active[gone]] = 0.0
            active = active[~gone]
    return counts


def best_fit(histogram: Mapping[int, int], capacity: int) -> list[Group]:
    """Best-fit by falling length over counts: the pieces of one length go
    to the open bins with the least room that takes them, as many as fit in
    each, then to new bins. Bins with equal content stay one group."""
    spaces: dict[int, list[Group]] = {}

    def put(space: int, content: list[tuple[int, int]], bins: int) -> None:
        if bins:
            spaces.setdefault(space, []).append((content, bins))

    for length in sorted(histogram, reverse=True):
        n = histogram[length]
        for space in sorted(s for s in spaces if s >= length):
            if not n:
                break
            per = space // length
            groups, changed = spaces.pop(space), []
            for content, bins in groups:
                full = min(bins, n // per)
                if full:
                    changed.append((space - per * length, content + [(length, per)], full))
                    n -= full * per
                    bins -= full
                if bins and 0 < n < per:
                    changed.append((space - n * length, content + [(length, n)], 1))
                    n, bins = 0, bins - 1
                if bins:
                    changed.append((space, content, bins))
            for c in changed:
                put(*c)
        per = capacity // length
        put(capacity - per * length, [(length, per)], n // per)
        if n % per:
            put(capacity - (n % per) * length, [(length, n % per)], 1)
    return [g for s in sorted(spaces) for g in spaces[s]]


def apply_patterns(h, patterns, counts, share: float) -> list[Group]:
    """Groups by falling repeat count, each cut to what its lengths still have
    in ``h`` (which is lowered), of which a ``share`` is kept."""
    import numpy as np
    groups: list[Group] = []
    for p in np.argsort(-counts, kind="stable"):
        if counts[p] <= 0:
            break
        need: dict[int, int] = {}
        for x in patterns[p].tolist():
            if x:
                need[x] = need.get(x, 0) + 1
        times = min(int(counts[p] * share), *[int(h[x]) // k for x, k in need.items()])
        if times > 0:
            for x, k in need.items():
                h[x] -= times * k
            groups.append((sorted(need.items(), reverse=True), times))
    return groups


def plan(histogram: Mapping[int, int], capacity: int, tries: int = 40) -> list[Group]:
    """Groups of sequences that hold exactly the histogram's pieces."""
    import numpy as np
    h = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        h[length] = n
    least = -(-int((h * np.arange(capacity + 1)).sum()) // capacity)  # no plan can do with fewer

    def rest_of(left) -> list[Group]:
        return best_fit({int(x): int(left[x]) for x in np.flatnonzero(left)}, capacity)

    def size(groups: list[Group]) -> int:
        return sum(times for _, times in groups)

    patterns = patterns_of(np.flatnonzero(h), capacity)
    if not len(patterns):
        return rest_of(h)
    counts = np.floor(fit_counts(patterns, h) + 1e-6).astype(np.int64)
    best = None
    for share in KEPT:
        left = h.copy()
        kept = apply_patterns(left, patterns, counts, share)
        rest = rest_of(left)
        total = size(kept) + size(rest)
        if best is None or total < best[0]:
            best = (total, kept, rest, left)
        if total <= least:
            break
    total, kept, rest, left = best
    # Patterns whose lengths stand in the worst filled sequences give their repeats back, one at a time.
    for _ in range(tries):
        if total <= least or not kept:
            break
        room = {x: capacity - sum(a * k for a, k in content) for content, _ in rest for x, _ in content}
        at = max(range(len(kept)), key=lambda i: (sum(room.get(x, 0) for x, _ in kept[i][0]), -i))
        content, times = kept[at]
        now = left.copy()
        for x, k in content:
            now[x] += times * k
        fewer = rest_of(now)
        if size(fewer) - times >= size(rest):
            break
        kept, rest, left = kept[:at] + kept[at + 1:], fewer, now
        total = size(kept) + size(rest)
    return kept + rest


def segments_of(groups: list[Group]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first number, past last number, first sequence, per sequence,
    offset): where the pieces of each length go by their number."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for content, times in groups:
        offset = 0
        for length, per in content:
            lo = used.get(length, 0)
            used[length] = lo + per * times
            out.append((length, lo, used[length], sequence, per, offset))
            offset += length * per
        sequence += times
    return out


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, text: str = "text", key: str = "doc_id",
           with_ids: bool = False, batch_bytes: int = 4 << 20, cache_size: int = 600_000) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) for every text."""
    ship_package()
    fields = [T.StructField("doc_id", docs.schema[key].dataType), T.StructField("piece", T.IntegerType()),
              T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
              T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def run(batches):
        import zlib
        import numpy as np
        import pyarrow as pa
        path = tokenizer_path(tokenizer)
        encoder = worker_state(("ids", path, cache_size), lambda: HfSegments(path, cache_size))
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            for lo, hi in slices_by_bytes(b.column("size").to_pylist(), batch_bytes):
                row, number, begin, length, crc, ids = [], [], [], [], [], []
                for k, raw in enumerate(encoder.id_bytes(b.column("text").slice(lo, hi - lo).to_pylist())):
                    raw += end
                    starts = piece_starts(len(raw) // 4, capacity)
                    for i, (s, e) in enumerate(zip(starts, [*starts[1:], len(raw) // 4])):
                        part = raw[4 * s:4 * e]
                        row.append(lo + k)
                        number.append(i)
                        begin.append(s)
                        length.append(e - s)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            ids.append(np.frombuffer(part, "<u4").astype(np.int32))
                columns = [b.column("doc_id").take(pa.array(row, pa.int64())), pa.array(number, pa.int32()),
                           pa.array(begin, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)
        give_back_memory()

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"),
                       F.coalesce(F.octet_length(text), F.lit(0)).alias("size"))
    return rows.mapInArrow(run, T.StructType(fields))


def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 2, capacity: int = 1024,
         text: str = "text", key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset)."""
    spark = docs.sparkSession
    cut = materialize(pieces(docs, tokenizer, end_id, capacity, text, key, with_ids), "pack-pieces")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # <= capacity rows
    where = spark.createDataFrame(
        segments_of(plan(histogram, capacity)),
        "_len long, _lo long, _hi long, _sequence long, _per long, _offset long")
    numbered = number_rows(cut, ["length"], ["doc_id", "piece", "ids_crc32"], "_n")
    placed = numbered.join(F.broadcast(where),  # bounded: a few rows per length
                           (F.col("length") == F.col("_len")) & (F.col("_n") >= F.col("_lo"))
                           & (F.col("_n") < F.col("_hi")))
    at = F.col("_n") - F.col("_lo")
    return placed.select(
        F.col("doc_id").alias(key), *cut.columns[1:],
        (F.col("_sequence") + F.floor(at / F.col("_per"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + (at % F.col("_per")) * F.col("length")).cast("long").alias("offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token sequences of ``pack(with_ids=True)``;
    a group holds at most ``capacity`` tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (packed.groupBy("sequence_id").agg(parts.alias("p"))
            .select("sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids")))

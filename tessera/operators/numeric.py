"""Compensated floating-point sums per group.

Spark has no compensated ``sum``, and a grouped pandas aggregate would pull
a whole group into one task. Instead:

1. ``mapInArrow``: per input partition and group key, a compensated partial
   sum as a double-double ``(hi, lo)``. Keys stay Arrow arrays (so a long
   beyond 2^53, a null and a NaN are what they are) and are dictionary
   encoded; all small groups of a batch are summed at once (Neumaier,
   vectorised over groups, one step per position), groups of ``SMALL_GROUP``
   values or more get the exact ``math.fsum`` and its residual. At
   ``PENDING`` states the pending ones are merged, and sent on if merging
   does not shrink them: memory is bounded whatever the number of keys.
2. The states are exchanged by key and sorted; a second ``mapInArrow`` merges
   runs of equal keys as they stream by. A key has about one state per input
   partition that held it, so even a hot key's task reads few rows.

Each step is at least as exact as a sequential Neumaier loop, so
``[1.0, 1e100, 1.0, -1e100]`` gives 2.0 on any partitioning, and no Python
loop runs over keys of fewer than ``SMALL_GROUP`` values.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import ship_package


# Groups with fewer values than this are summed together, vectorised over
# groups; larger ones one by one with math.fsum (at most rows / this many).
SMALL_GROUP = 32
# States a map task holds before it merges them, and sends them on.
PENDING = 200_000


def _double_double(values: np.ndarray) -> tuple[float, float]:
    """Exact sum of ``values`` as ``hi + lo`` (``hi`` the correctly rounded
    sum, ``lo`` the rounded residual); plain sum when not all are finite."""
    if not np.all(np.isfinite(values)):
        total = float(np.sum(values))
        return total, 0.0
    hi = math.fsum(values)
    if not math.isfinite(hi):
        return hi, 0.0
    lo = math.fsum(np.append(values, -hi))
    return hi, lo


def _neumaier_columns(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row-wise Neumaier sums of a zero-padded matrix (adding 0 is exact),
    one vectorised step per column. Returns (s, c) per row."""
    s = np.zeros(m.shape[0])
    c = np.zeros(m.shape[0])
    with np.errstate(invalid="ignore", over="ignore"):
        for j in range(m.shape[1]):
            x = m[:, j]
            t = s + x
            comp = np.where(np.abs(s) >= np.abs(x), (s - t) + x, (x - t) + s)
            c += np.where(np.isfinite(t), comp, 0.0)
            s = t
    return s, c


def _group_states(codes: np.ndarray, vals: np.ndarray, n_groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Per group code in [0, n_groups): compensated (hi, lo) of its values."""
    hi = np.zeros(n_groups)
    lo = np.zeros(n_groups)
    if len(vals) == 0:
        return hi, lo
    order = np.argsort(codes, kind="stable")
    codes, vals = codes[order], vals[order]
    sizes = np.bincount(codes, minlength=n_groups)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    pos = np.arange(len(vals)) - starts[codes]
    small = sizes[codes] < SMALL_GROUP
    if small.any():
        width = int(sizes[sizes < SMALL_GROUP].max())
        m = np.zeros((n_groups, width))
        m[codes[small], pos[small]] = vals[small]
        s, c = _neumaier_columns(m)
        with np.errstate(invalid="ignore", over="ignore"):
            total = s + c
            resid = np.where(np.isfinite(total), c - (total - s), 0.0)
        mask = (sizes < SMALL_GROUP) & (sizes > 0)
        hi[mask], lo[mask] = total[mask], resid[mask]
    for g in np.flatnonzero(sizes >= SMALL_GROUP):
        hi[g], lo[g] = _double_double(vals[starts[g]:starts[g] + sizes[g]])
    return hi, lo


def _codes(columns: Sequence[pa.Array], rows: int) -> np.ndarray:
    """One code per row, equal for rows with equal keys (nulls equal nulls,
    NaNs equal NaNs)."""
    code = np.zeros(rows, dtype=np.int64)
    for c in columns:
        if pa.types.is_nested(c.type):
            texts = pa.array([None if v is None else repr(v) for v in c.to_pylist()], pa.string())
            c = texts
        d = c.dictionary_encode(null_encoding="encode")
        code = code * max(1, len(d.dictionary)) + d.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        code = np.unique(code, return_inverse=True)[1]
    return code


def _merged(keys: Sequence[pa.Array], hi: np.ndarray, lo: np.ndarray, n: np.ndarray):
    """The states of rows with equal keys merged; keys of first occurrence,
    in that order."""
    code = _codes(keys, len(hi))
    _, first, code = np.unique(code, return_index=True, return_inverse=True)
    order = np.argsort(first, kind="stable")
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    code, first = place[code], first[order]
    some = n > 0
    twice = np.concatenate([code[some], code[some]])
    h, e = _group_states(twice, np.concatenate([hi[some], lo[some]]), len(first))
    at = pa.array(first, pa.int64())
    return [k.take(at) for k in keys], h, e, np.bincount(code, n, len(first)).astype(np.int64)


def _joined(parts: list) -> tuple:
    keys = [pa.concat_arrays([p[0][j] for p in parts]) for j in range(len(parts[0][0]))]
    return keys, *[np.concatenate([p[i] for p in parts]) for i in (1, 2, 3)]


def _partials(keys: Sequence[str], value: str):
    names = [*keys, "_hi", "_lo", "_n"]

    def batch_of(state) -> pa.RecordBatch:
        k, hi, lo, n = state
        return pa.RecordBatch.from_arrays([*k, pa.array(hi), pa.array(lo), pa.array(n)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list = []
        held = 0
        for b in batches:
            if not b.num_rows:
                continue
            v = b.column(value)
            ok = ~v.is_null().to_numpy(zero_copy_only=False)
            x = np.where(ok, v.fill_null(0.0).to_numpy(zero_copy_only=False), 0.0)
            state = _merged([b.column(k) for k in keys], x, np.zeros(len(x)), ok.astype(np.int64))
            pending.append(state)
            held += len(state[1])
            if held >= PENDING:
                state = _merged(*_joined(pending))
                held = len(state[1])
                pending = [state]
                if held >= PENDING // 2:
                    yield batch_of(state)
                    pending, held = [], 0
        if pending:
            yield batch_of(_merged(*_joined(pending)))
    return run


def _totals(keys: Sequence[str], out: str):
    """Merges runs of equal keys of sorted states; a run that may go on in
    the next batch is held back as one state."""
    names = [*keys, out]

    def finished(state, count: int) -> pa.RecordBatch:
        k, hi, lo, n = state
        with np.errstate(invalid="ignore", over="ignore"):
            total = np.where(np.isfinite(hi), hi + lo, hi)[:count]
        return pa.RecordBatch.from_arrays(
            [*[x.slice(0, count) for x in k], pa.array(total, mask=n[:count] == 0)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for b in batches:
            if not b.num_rows:
                continue
            state = ([b.column(k) for k in keys], *[b.column(c).to_numpy(zero_copy_only=False) for c in ("_hi", "_lo", "_n")])
            state = _merged(*_joined([last, state])) if last is not None else _merged(*state)
            size = len(state[1])
            if size > 1:
                yield finished(state, size - 1)
            last = ([k.slice(size - 1, 1) for k in state[0]], *[x[size - 1:] for x in state[1:]])
        if last is not None:
            yield finished(last, 1)
    return run


def compensated_sum(df: DataFrame, value: str, keys: Sequence[str] = (),
                    out: str = "total") -> DataFrame:
    """(keys..., total): compensated sum of ``value`` per group, or over
    everything when ``keys`` is empty. Nulls are skipped; like SQL ``sum``,
    a group (or an input) without non-null values gives null. Keys group as
    in SQL: nulls together, NaNs together, -0.0 with 0.0."""
    keys = list(keys)
    ship_package(df.sparkSession)
    floats = (T.DoubleType, T.FloatType)
    key_cols = [(F.col(k) + F.lit(0.0).cast(df.schema[k].dataType)).alias(k)
                if isinstance(df.schema[k].dataType, floats) else F.col(k) for k in keys]
    src = df.select(*key_cols, F.col(value).cast("double").alias("_value"))
    fields = [T.StructField(k, df.schema[k].dataType) for k in keys]
    states = T.StructType([*fields, T.StructField("_hi", T.DoubleType()), T.StructField("_lo", T.DoubleType()),
                           T.StructField("_n", T.LongType())])
    parts = src.mapInArrow(_partials(keys, "_value"), states)
    totals = T.StructType([*fields, T.StructField(out, T.DoubleType())])
    if not keys:
        return parts.repartition(1).mapInArrow(_totals(keys, out), totals).agg(F.first(out).alias(out))
    by_key = parts.repartition(*keys).sortWithinPartitions(*keys)
    return by_key.mapInArrow(_totals(keys, out), totals)

"""Joins that stay balanced when a few keys are very heavy.

AQE splits a skewed sort-merge join only when both inputs are fresh shuffle
outputs. A lookup side that comes out of an aggregate on the join key is
already partitioned by it, gets no exchange, and a heavy key's rows then all
land in one task. :func:`skew_safe_join` joins on the key *and* its hash: the
aggregate's partitioning no longer serves, so the lookup side is exchanged
too, and AQE may split a heavy key's rows over tasks (repeating the lookup's
one row per key for each). The plan is the same at every size, lazy, and
needs no counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Most keys whose self-join may be sliced (broadcast rows).
HOT_BOUND = 100_000


def skew_safe_join(big: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """``big.join(lookup, on, how)`` (inner or left) for a lookup with one
    row per key, with an exchange on both sides."""
    on = list(on)
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    h = F.xxhash64(*on)
    return big.withColumn("_hash", h).join(lookup.withColumn("_hash", h), [*on, "_hash"], how).drop("_hash")


# Pairs one task slice may form for a single key of a self-join.
SLICE_PAIRS = 100_000_000


def skew_safe_pairs(left: DataFrame, right: DataFrame, on: str, spread_by: str,
                    bound: int = HOT_BOUND, slice_pairs: int = SLICE_PAIRS) -> DataFrame:
    """Join of ``left`` and ``right`` on ``on`` where both sides hold the
    same ``k`` rows per key, so a key forms about ``k * k`` pairs.

    Input sizes do not show that output: AQE sees a few kilobytes for a key
    that yields billions of rows. A key with ``k * k`` above ``slice_pairs``
    (and ``k`` above ``total / bound``, so fewer than ``bound`` such keys:
    broadcast under a proven bound) has its left rows split into
    ``ceil(k * k / slice_pairs)`` slices by a hash of ``spread_by``, and its
    right rows repeated once per slice; each (key, slice) then forms at most
    about ``slice_pairs`` pairs in one task.
    """
    counts = left.groupBy(on).agg(F.count(F.lit(1)).alias("_k"))
    total = counts.agg(F.sum("_k")).scalar()
    k = F.col("_k").cast("double")
    floor = F.greatest(F.sqrt(F.lit(float(slice_pairs))), total / F.lit(bound))
    slices = F.when(k > floor, F.least(F.ceil(k * k / F.lit(float(slice_pairs))), F.col("_k")))
    hot = counts.select(on, slices.cast("int").alias("_n")).filter(F.col("_n") > 1)
    n = F.coalesce(F.col("_n"), F.lit(1))
    lt = (left.join(F.broadcast(hot), on, "left")
          .withColumn("_slice", F.pmod(F.xxhash64(F.col(spread_by)), n).cast("int")).drop("_n"))
    rt = (right.join(F.broadcast(hot), on, "left")
          .withColumn("_slice", F.explode(F.sequence(F.lit(0), n - 1))).drop("_n"))
    return lt.join(rt, [on, "_slice"]).drop("_slice")

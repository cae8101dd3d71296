"""Mixing sources to target weights by a time-varying curriculum
(operator 7, DataFrame functions only).

Sources, ordered by code point with null last, carry the weights of a
repeating pattern and share ``share`` times all words; a source takes at
most ``cap`` times its size, and what it cannot take is shared again by
weight among the rest. Within its target each source follows a weight
schedule over training time t in [0, 1]: a linear ramp w(t) = 1 + r (2t - 1)
whose slope r depends on the source, so that its integral is the demand
D(t) = (1 - r) t + r t^2 times the target. Whole passes over the source,
each in its own stable order, fill the demand; a copy that starts after c
words gets the training position t with D(t) = c / target, inverted in
closed form, and the mix is the range sort of all copies by position.
:func:`scheduled` runs all of it over narrow rows and writes the result.

A document is taken a whole number of times: every document once per full
pass, plus once if it comes within the last, partial pass. Sums stay within
half a document of the target.

Defined results: a null or blank text has size 0 and takes 0 words; sources
of size 0 have target 0; equal rows are interchangeable; extra columns are
kept by :func:`curriculum` (one called like the position is replaced) and
not read otherwise; very long texts are counted whole; an empty table gives an empty result. The table of sources is combined map-side and joined, never
collected; the sharing runs as one window aggregate over it.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, materialize, number_rows, packed, unpacked

WEIGHTS = (3, 1, 2)
SLOPES = (-0.5, 0.0, 0.5)


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: Fraction = Fraction(3, 2),
                   cap: int = 2) -> DataFrame:
    """(source, source_size, rank, weight, target) from (source, source_size).

    Sharing again until no source is above its cap has a closed form: with
    sources in rising order of size / weight, those before some point are
    capped, and the rest get (all words to share - what the capped take) in
    proportion to weight; the point is the first whose share stays below
    its cap. One window over the table of sources finds it.
    """
    pattern = F.array(*[F.lit(float(w)) for w in weights])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = (sizes.withColumn("rank", (F.row_number().over(by_name) - 1).cast("int"))
         .withColumn("weight", pattern[F.col("rank") % len(weights)]))
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    pot = F.sum("source_size").over(everything) * F.lit(float(share))
    s = (s.withColumn("_left", pot - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
         .withColumn("_rate", F.col("_left") / F.sum("weight").over(onward))
         .withColumn("_under", F.col("_rate") * F.col("weight") <= cap * F.col("source_size")))
    # The first source whose share fits fixes the rate for itself and all after it.
    rate = F.min_by(F.when(F.col("_under"), F.col("_rate")), F.when(
        F.col("_under"), F.struct(F.col("source_size") / F.col("weight"), F.col("rank")))).over(everything)
    s = s.withColumn("_final", rate)
    full = F.lit(float(cap)) * F.col("source_size")
    target = F.when(F.col("_final").isNull(), full).otherwise(F.least(F.col("_final") * F.col("weight"), full))
    return s.select("source", "source_size", "rank", "weight", target.cast("double").alias("target"))


def inverse_demand(done: Column, slope: Column) -> Column:
    """t with (1 - r) t + r t^2 = done, for |r| <= 1."""
    r, b = slope, 1 - slope
    root = (-b + F.sqrt(F.greatest(b * b + 4 * r * done, F.lit(0.0)))) / (2 * r)
    return F.when((F.abs(r) < 1e-9) | (done <= 0), done).otherwise(root)


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id",
        weights: Sequence[int] = WEIGHTS, share: Fraction = Fraction(3, 2), cap: int = 2,
        slopes: Sequence[float] = SLOPES, carry: Sequence[str] = ()) -> DataFrame:
    """(key, size, source_size, target, taken, copies, positions) per row,
    plus the narrow columns of ``carry``; ``positions`` are the training
    positions of its copies."""
    rows = materialize(docs.select(
        F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"), *carry), "mix-rows")
    targets = materialize(source_targets(
        rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap), "mix-targets")
    placed = number_rows(rows, ["source"], ["doc_id", "size"], "start", amount="size")
    t = targets.withColumnRenamed("source", "_source")
    j = placed.join(t, F.col("source").eqNullSafe(F.col("_source")))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - passes * F.col("source_size")
    # In the partial pass, a document is taken when its middle word is.
    again = ((F.col("start") + F.col("size") / 2.0) < rest) & (passes < cap)
    copies = F.when(F.col("size") > 0, passes + again.cast("int")).otherwise(0).cast("int")
    slope = F.array(*[F.lit(float(x)) for x in slopes])[F.col("rank") % len(slopes)]
    at = F.transform(
        F.when(F.col("copies") > 0, F.sequence(F.lit(0), F.col("copies") - 1)).otherwise(F.array().cast("array<int>")),
        lambda k: inverse_demand(F.least((F.col("start") + k * F.col("source_size")) / F.col("target"), F.lit(1.0)),
                                 F.col("slope")))
    return (j.withColumn("copies", copies).withColumn("slope", slope)
            .select(F.col("doc_id").alias(key), "source", "size", "source_size", "target",
                    (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies",
                    at.alias("positions"), *carry))


def scheduled(docs: DataFrame, **options) -> DataFrame:
    """(key, size, source_size, target, taken, copies, copy, position,
    last_position), range-sorted by training position and written: a row per
    copy (numbered from 0) with its own and the document's last position, and
    one without (last) for each document not taken. Rows whose ``copy`` is 0
    or null are the documents, each once."""
    key = options.get("key", "doc_id")
    plan = materialize(mix(docs, **options), "mix-plan")
    rows = plan.select(key, "size", "source_size", "target", "taken", "copies",
                       F.posexplode_outer("positions").alias("copy", "position"),
                       F.array_max("positions").alias("last_position"))
    at = F.col("position").asc_nulls_last()
    return materialize(rows.repartitionByRange(at, key, "size").sortWithinPartitions(at, key, "size"), "mix-order")


def ordered_mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                **options) -> DataFrame:
    """(row, position): every row of ``docs``, as a struct, once per copy,
    range-sorted by training position. Rows equal in all columns are stored
    once and meet the copies of each."""
    rows = packed(docs, *[F.col(c).alias(c) for c in (key, text, source)])
    rows = rows.withColumn("_row", F.xxhash64("row"))
    plan = mix(rows, key=key, text=text, source=source, carry=("_row",), **options).filter("copies > 0").select(
        F.col(key).alias("_k"), F.col("_row").alias("_r"), F.explode("positions").alias("position"))
    once = rows.select("row", F.col(key).alias("_id"), "_row").dropDuplicates(["_id", "_row"])
    out = once.join(plan, F.col("_id").eqNullSafe(F.col("_k")) & (F.col("_row") == F.col("_r")))
    return (out.select("row", "position", "_id").repartitionByRange("position", "_id")
            .sortWithinPartitions("position", "_id").drop("_id"))


def curriculum(docs: DataFrame, position: str = "position", **options) -> DataFrame:
    """The mix itself: ``docs`` once per copy plus the training position (in
    place of a column so called), sorted by it."""
    out = ordered_mix(docs, **options)
    return out.select(*unpacked(docs.columns, (position,)), F.col("position").alias(position))

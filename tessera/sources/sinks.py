"""Sinks: pair text in the ``(key,value)`` tuple style, bare values as text,
and headerless CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tuple_text(cols: Sequence[str | Column | Sequence]) -> Column:
    """``(a,b)`` text of columns; a nested sequence becomes a nested tuple,
    ``(CA,(5000,2,2))``. Nulls print as ``null``."""
    def part(c) -> Column:
        if isinstance(c, (list, tuple)):
            return tuple_text(c)
        col = F.col(c) if isinstance(c, str) else c
        return F.coalesce(col.cast("string"), F.lit("null"))
    return F.concat(F.lit("("), F.concat_ws(",", *[part(c) for c in cols]), F.lit(")"))


def write_tuple_text(df: DataFrame, path: str, cols: Sequence[str | Column | Sequence],
                     mode: str = "errorifexists", partitions: int | None = None) -> None:
    """One ``(k,v)`` line per row as text part files. Like saving an RDD as
    text, an existing path is refused unless ``mode`` says otherwise.
    ``partitions`` fixes the number of part files (a shuffle)."""
    out = df.select(tuple_text(cols).alias("value"))
    if partitions is not None:
        out = out.repartition(partitions)
    out.write.mode(mode).text(path)


def write_value_text(df: DataFrame, path: str, col: str | Column, mode: str = "errorifexists",
                     partitions: int | None = None) -> None:
    """One bare value per line (a count saved as ``2``), null as ``null``;
    otherwise like :func:`write_tuple_text`."""
    value = F.col(col) if isinstance(col, str) else col
    out = df.select(F.coalesce(value.cast("string"), F.lit("null")).alias("value"))
    if partitions is not None:
        out = out.repartition(partitions)
    out.write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = False,
              sep: str = ",", partitions: int | None = None) -> None:
    """CSV part files, by default headerless and overwriting. Null is
    written as nothing, an empty string as ``""``. ``partitions`` fixes the
    number of part files (a shuffle)."""
    out = df if partitions is None else df.repartition(partitions)
    out.write.mode(mode).option("header", str(header).lower()).option("sep", sep).csv(path)

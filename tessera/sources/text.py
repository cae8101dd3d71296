"""Text sources: lines, space-separated edge lists, and tab-separated
records, either parsed from lines (the text jobs' rules) or read by Spark's
CSV reader (the DataFrame job's rules). The two differ on purpose: the CSV
reader pads short rows, cuts long ones and honours quotes; the line parser
does none of that."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.tokens import PY_WHITESPACE_CLASS


def read_lines(spark: SparkSession, path: str | list[str], with_path: bool = False) -> DataFrame:
    """``value`` per line of a text file, folder or glob; with ``with_path``
    also ``file_path`` (from the hidden ``_metadata`` column)."""
    df = spark.read.text(path)
    if with_path:
        return df.select("value", F.col("_metadata.file_path").alias("file_path"))
    return df


def read_numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file_path, line_number, value): every line with its 1-based number
    within its file, blank lines counted, without reading a file in one task.

    A file is scanned in splits; each split knows its byte offset in the
    file, and rows keep their order within a split. Lines are counted per
    split (a small table: one row per split), a running sum over a file's
    splits in offset order gives each split's first line number, and a
    line's number is that plus its position within the split.

    The split table has at most (files + scan partitions) rows; whether it
    is broadcast or met by a shuffle is left to Spark's own size check.
    """
    text = spark.read.text(path)
    raw = text.select(
        "value", F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"))
    splits = raw.groupBy("file_path", "_block").agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("file_path").orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = splits.select("file_path", "_block", "_first",
                           F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return raw.join(starts, ["file_path", "_block"]).select(
        "file_path", (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line_number"),
        "value")


def _literal(sep: str) -> str:
    """A separator as a regex that matches just itself."""
    return re.escape(sep)


def parse_edges(lines: DataFrame, col: str = "value", sep: str = " ") -> DataFrame:
    """(src, dst) strings: the first two fields split at one ``sep`` (taken
    literally). Lines without a second field, or with a blank last one (which
    the reference's split drops), go (the reference would raise); extra
    fields are ignored. Each line is split once: the fields pass a generator,
    which keeps the optimizer from copying the split into every test."""
    parts = F.split(F.col(col), _literal(sep), -1)
    once = lines.select(F.inline(F.array(F.struct(parts.alias("p")))))
    # The reference's split drops blank fields at the end: the second counts
    # only if it, or a later one, is not blank.
    tail = F.exists(F.slice("p", 2, F.greatest(F.size("p"), F.lit(1))), lambda x: x != "")
    return once.filter((F.size("p") >= 2) & tail).select(F.col("p")[0].alias("src"), F.col("p")[1].alias("dst"))


def _as_struct(schema: T.StructType | str) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    return T.StructType.fromDDL(schema)


def parse_tsv(lines: DataFrame, schema: T.StructType | str, col: str = "value",
              sep: str = "\t", header_prefix: str | None = None,
              exact_fields: bool = True, strip: bool = False,
              required: list[str] | None = None, on_error: str = "drop",
              trailing_empty: bool = True) -> DataFrame:
    """Typed columns from separated lines, by the text jobs' rules.

    - split with limit -1: trailing empty fields are kept (with
      ``trailing_empty=False`` they are dropped, as Java's ``split`` does in
      the RDD version of the city job, so a blank last field makes the line
      too short);
    - a line starting with ``header_prefix`` is a header and goes;
    - the field count must equal the schema's (``exact_fields``) or reach
      it; short lines always go, extra fields are ignored;
    - with ``strip`` the line first loses its leading and trailing blanks as
      Python's ``str.strip()`` does (tabs included, so a blank first field
      disappears, as in the MapReduce version of the city job);
    - ``sep`` is taken literally;
    - non-string fields go through ``try_cast`` (which trims blanks, so
      ``" 10"`` is 10);
    - a row whose ``required`` fields (default: every non-string field) are
      null or fail to cast is dropped; with ``on_error='fail'`` a field that
      is there but fails to cast raises, whatever the session's ANSI setting.

    Each line is split and cast once: fields pass a generator, which keeps
    the optimizer from copying them into every later test.
    """
    if on_error not in ("drop", "fail"):
        raise ValueError("on_error must be 'drop' or 'fail'")
    st = _as_struct(schema)
    n = len(st.fields)
    ws = PY_WHITESPACE_CLASS
    line = F.col(col)
    text = F.regexp_replace(line, f"^{ws}+|{ws}+$", "") if strip else line
    if not trailing_empty:
        text = F.regexp_replace(text, f"(?:{_literal(sep)})+\\z", "")
    header = F.lit(False) if header_prefix is None else F.coalesce(line.startswith(header_prefix), F.lit(False))
    parts = F.when(~header, F.split(text, _literal(sep), -1))
    fields = lines.select(F.inline(F.array(F.struct(parts.alias("p")))))
    count = F.size("p")
    fields = fields.filter((count == n) if exact_fields else (count >= n))

    def typed(i: int, f: T.StructField) -> Column:
        raw = F.col("p")[i]
        if isinstance(f.dataType, T.StringType):
            return raw.alias(f.name)
        value = raw.try_cast(f.dataType)
        if on_error == "fail":
            told = F.raise_error(F.concat(F.lit(f"{f.name}: not {f.dataType.simpleString()}: "), raw))
            value = F.when(raw.isNotNull() & value.isNull(), told.cast(f.dataType)).otherwise(value)
        return value.alias(f.name)

    out = fields.select(F.inline(F.array(F.struct(*[typed(i, f) for i, f in enumerate(st.fields)]))))
    need = required if required is not None else [
        f.name for f in st.fields if not isinstance(f.dataType, T.StringType)]
    for name in need:
        out = out.filter(F.col(name).isNotNull())
    return out


def read_tsv(spark: SparkSession, path: str | list[str], schema: T.StructType | str,
             header: bool = True, sep: str = "\t", mode: str = "PERMISSIVE") -> DataFrame:
    """A separated file by Spark's CSV reader with a declared schema (never
    inferred): blanks read as null, quotes honoured, and in ``PERMISSIVE``
    mode short rows padded with nulls."""
    return (spark.read.option("sep", sep).option("header", str(header).lower())
            .option("mode", mode).schema(_as_struct(schema)).csv(path))

"""Helpers shared by the operators of this subpackage: materialised tables,
gapless numbering without a single-task sort, stable bounded samples,
worker-side state, tokenizer paths."""

from __future__ import annotations

import pickle
import sys
import types
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir, ship_package

# Fixed value: a word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_SCRATCH: ContextVar[list[str] | None] = ContextVar("tessera_scratch", default=None)


def materialize(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet below the session's shared checkpoint folder
    and read it back: later steps read the table instead of recomputing its
    lineage, and it survives lost executors. Inside :func:`scratch` the
    table goes when the scope ends, unless ``keep``; otherwise the caller
    (or the cluster's clean-up of that folder) removes it."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/tessera-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    tables = _SCRATCH.get()
    if tables is not None and not keep:
        tables.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables materialised inside when it ends: for an operator
    whose result is itself a kept table, so that nothing reads them later.
    An inner scope leaves its tables to the outer one."""
    if _SCRATCH.get() is not None:
        yield
        return
    tables: list[str] = []
    token = _SCRATCH.set(tables)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in tables:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)


def packed(df: DataFrame, *columns: Column) -> DataFrame:
    """``row`` (all columns of ``df`` as one struct) plus ``columns``: the
    operator's own columns then cannot clash with those of ``df``."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *columns)


def unpacked(names: Sequence[str], outputs: Sequence[str] = ()) -> list[Column]:
    """The fields of ``row``, less those called like an output."""
    taken = {c.lower() for c in outputs}
    return [F.col("row")[c].alias(c) for c in names if c.lower() not in taken]


def utf8_bytes(text: str | Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def utf8_crc32(text: str | Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; a null text counts as empty."""
    return F.crc32(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary"))


def id_crc_mod(key: str, n: int) -> Column:
    """crc32 of the key's text modulo ``n``; a null key counts as ''."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % n


def number_rows(df: DataFrame, groups: Sequence[str], keys: Sequence[str], out: str,
                amount: str | None = None, digits: int = 3) -> DataFrame:
    """Gapless number of each row within its group (from 0), or with
    ``amount`` the sum of the amounts of the rows before it in the group,
    in the order of the MD5 of the keys' text (then of the keys).

    Rows are dealt to 16^digits buckets by the first hex digits of that MD5,
    so a group holding a third of all rows is numbered by many tasks: bucket
    totals (at most groups x buckets rows, combined map-side) give each
    bucket its start, a window within (group, bucket) the rest. The order
    depends on the keys alone, so reruns agree; rows equal in all keys are
    interchangeable. ``df`` is read twice: pass a materialised table.
    """
    group_cols, b = list(groups), "_bucket"
    name = F.concat_ws(":", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    dealt = df.withColumn("_h", F.md5(name)).withColumn(b, F.substring("_h", 1, digits))
    value = F.lit(1).cast("long") if amount is None else F.col(amount).cast("long")
    totals = dealt.groupBy(*group_cols, b).agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*group_cols).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group_cols)], F.col(b).alias("_b2"),
                           F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    inside = (Window.partitionBy(*group_cols, b).orderBy("_h", *keys)
              .rowsBetween(Window.unboundedPreceding, -1))
    ranked = dealt.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    on = F.col(b) == F.col("_b2")
    for i, c in enumerate(group_cols):
        on = on & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return (ranked.join(starts, on)
            .withColumn(out, (F.col("_start") + F.col("_in")).cast("long"))
            .drop("_h", b, "_in", "_start", "_b2", *[f"_g{i}" for i in range(len(group_cols))]))


def worker_state(key: Any, build: Callable[[], Any], most: int = 4) -> Any:
    """One object per Python worker process and key (a loaded tokenizer or
    model, a bounded cache), kept between the tasks of a reused worker; the
    ``most`` used last stay."""
    holder = sys.modules.setdefault("_tessera_worker_state", types.ModuleType("_tessera_worker_state"))
    table = holder.__dict__.setdefault("table", {})
    value = table.pop(key) if key in table else build()
    table[key] = value
    while len(table) > most:
        table.pop(next(iter(table)))
    return value


def share(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast an object of this package (its size bounded by the caller)
    to Python workers that need not have the package: the returned function
    gives it there, loaded once per worker, which holds the one used last:
    models of earlier stages and runs would stay in its memory."""
    ship_package()
    data, name = spark.sparkContext.broadcast(cloudpickle.dumps(value)), uuid.uuid4().hex

    def load() -> Any:
        held = worker_state("shared", dict)
        if name not in held:
            held.clear()
            held[name] = pickle.loads(data.value)
        return held[name]

    return load


def tokenizer_path(name: str) -> str:
    """A tokenizer file: a full path as is, else the public tokenizer of that
    name, looked up where the code runs (driver or worker)."""
    if "/" in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


def give_back_memory() -> None:
    """Return freed buffers of a Python worker to the system: a reused
    worker otherwise carries one stage's peak through the next."""
    import ctypes
    import gc

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: nothing to do
        pass


class TwoTierCache:
    """A bounded dictionary: two generations of at most ``size`` entries;
    entries used again survive the drop of the old generation."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def lookup(self, key):
        """The value, or None; moves a value of the old generation up."""
        v = self.young.get(key)
        if v is None:
            v = self.old.get(key)
            if v is not None:
                self.put(key, v)
        return v

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value

    def extend(self, items) -> None:
        """Many entries at once; the generation may end that much above
        ``size``."""
        self.young.update(items)
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}

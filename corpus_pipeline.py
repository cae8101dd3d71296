"""From raw documents to packed training sequences: five stages, each one
operator of ``tessera.llm``, each written as Parquet and read again by the
next. Every stage works on all that its predecessor kept, and all but the
last return the columns of ``documents``.

Defined results: rows whose id is null pass every stage like others; documents
that repeat an id with the same text count as one from the near-duplicate
stage on, those that repeat it with another text are judged by their own text.
Null and blank texts have no language and go in the first stage; null language,
source or length changes nothing but the source mix, where a null source is
the last one. Very long texts pass every stage whole and are cut into pieces
only when packed. Ties: equal code lengths go to the language that sorts
first, of equal documents the smallest id stays (then a hash of id and text),
equal rows of a mix are interchangeable. Extra columns, also those called like
an operator's own, are kept up to the last stage, which does not read them. An
empty table gives empty stages and an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import langid, mixing, near_dup, packing, secrets
from tessera.llm.common import documents, id_crc_mod, materialize, packed


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no letter, or no language that
    holds half the weight."""
    model = langid.train(docs.filter(id_crc_mod("doc_id", 5) != 0))
    seen = langid.identified(docs, model)
    return seen.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= 0.5)).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five-word
    shingles, similarity 0.8): the one with the smallest id."""
    rows = packed(docs, F.col("doc_id"), F.xxhash64("text").alias("hash"))
    judged = near_dup.near_duplicates(docs.select("doc_id", "text", F.xxhash64("text").alias("hash")),
                                      words=5, percent=80, carry=("hash",))
    gone = judged.filter("NOT kept").select(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash"))
    return rows.join(gone, same, "left_anti").dropDuplicates(["doc_id", "hash"]).select("row.*")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are masked; no document goes, and texts without a
    secret keep their length and content."""
    masked = secrets.redact(packed(docs, F.col("text")))
    changed = ~F.col("text").eqNullSafe(F.col("row.text"))
    fresh = {"text": F.col("text"),
             "n_chars": F.when(changed, F.length("text").cast("long")).otherwise(F.col("row.n_chars"))}
    return masked.select(*[fresh.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return mixing.ordered_mix(docs).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents placed in sequences of 1024 tokens."""
    return packing.pack(docs, "byte_bpe_50k.json", end_id=2, capacity=1024)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# SQL cannot express the trained language model, the tokenizer or the packing;
# tests/llm checks the stages against brute force.
ORACLE_SQL = None

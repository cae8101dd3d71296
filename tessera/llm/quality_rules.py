"""Quality rules as a bitmask ledger (operator 3, DataFrame functions only).

Every rule is evaluated once per document. The ledger keeps the
measurements and one long with a bit per failed rule; a *policy* is a named,
versioned mask over those bits, so applying another policy, or asking what
each rule removes, never reads a text again. Ablations group the distinct
bit patterns (at most 2^rules, combined map-side) and work on masks.

Words are runs of characters other than ASCII white space. Measurements:
``n_words``; ``word_chars`` (code points in words); ``n_symbols``;
``n_dup_lines`` (lines with a word that equal an earlier line);
``n_repeat_words`` (words in three-word windows found twice or more in the
text, the first included). Windows are compared by 64-bit hash within one
text (a text of a million words meets a chance of 3e-8 of one collision).

Defined results: a null text has no words and fails the base rules; so does
an empty one; documents are judged one by one, so ties and repeated rows
change nothing; extra columns are kept as named, those called like an output
replaced; an empty table gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import SPACE, WORD

# Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

# Rule name -> failure condition over the measurements, one bit each in this
# order. Conditions multiply out instead of dividing, so none is null.
RULES: dict[str, str] = {
    "few_words": f"n_words < {MIN_WORDS}",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbol_heavy": "10 * n_symbols > 3 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
}
BASE = ("few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    """A versioned choice of rules: a document is kept when none of the
    chosen rules failed."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        names = list(RULES)
        return sum(1 << names.index(r) for r in self.rules)


POLICIES = {p.name: p for p in (
    Policy("base", 1, BASE),
    Policy("web", 1, BASE + ("symbol_heavy", "short_words")),
    Policy("web_strict", 2, tuple(RULES)),
)}


def _text_arrays(rows: DataFrame) -> DataFrame:
    """From ``_text``, the words, the lines with a word, and two counts."""
    t = F.col("_text")
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.length(F.regexp_replace(x, F.lit(SPACE), F.lit(""))) > 0)
    return (rows.withColumn("_words", F.regexp_extract_all(t, F.lit(WORD), F.lit(0)))
            .withColumn("_lines", lines)
            .withColumn("word_chars", F.length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("long"))
            .withColumn("n_symbols", (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long")))


def _windows(df: DataFrame) -> DataFrame:
    w = F.col("_words")
    hashes = F.when(F.size(w) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2])))
    return df.withColumn("_hash", F.coalesce(hashes, F.array().cast("array<bigint>")))


def _repeated_positions(df: DataFrame) -> DataFrame:
    """Start positions, in order, of windows whose hash occurs again: one
    sort of (hash, position) puts equal windows side by side. Texts in which
    no window repeats skip the sort."""
    pairs = F.array_sort(F.transform(F.col("_hash"), lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    some = F.size(F.array_distinct("_hash")) < F.size("_hash")
    df = df.withColumn("_pairs", F.when(some, pairs))
    p = F.col("_pairs")
    same = F.filter(p, lambda x, i: (F.try_element_at(p, i + 2)["h"] == x["h"])
                    | ((i > 0) & (F.try_element_at(p, F.greatest(i, F.lit(1)))["h"] == x["h"])))
    return df.withColumn("_starts", F.array_sort(F.transform(same, lambda x: x["p"])))


def _covered(starts: Column) -> Column:
    """Words covered by the three-word windows at these sorted starts: each
    adds three words, less its overlap with the next window."""
    return F.coalesce(F.aggregate(
        starts, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
        lambda a, s: F.struct((a["n"] + F.least(F.lit(3), s - a["last"])).alias("n"), s.alias("last")),
        lambda a: a["n"]), F.lit(0)).cast("long")


def ledger(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` (less columns called like an output), the measurements and
    ``failed_bits`` per row of ``docs``; one stage, no shuffle."""
    kept = [c for c in keep if c not in (*MEASURES, "failed_bits")]
    rows = docs.select(F.struct(F.lit(0).alias("_"), *kept).alias("_keep"),
                       F.coalesce(F.col(text), F.lit("")).alias("_text"))
    d = _repeated_positions(_windows(_text_arrays(rows)))
    measured = (d.withColumn("n_words", F.size("_words").cast("long"))
                .withColumn("n_lines", F.size("_lines").cast("long"))
                .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
                .withColumn("n_repeat_words", _covered(F.col("_starts")))
                .select("_keep", *MEASURES))
    bits = F.lit(0).cast("long")
    for k, condition in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return measured.select(*[F.col("_keep")[c].alias(c) for c in kept], *MEASURES, bits.alias("failed_bits"))


def passes(policy: Policy) -> Column:
    return F.col("failed_bits").bitwiseAND(F.lit(policy.mask)) == 0


def ablations(entries: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents that fail it, documents that fail
    it alone (kept again if it were dropped), and documents kept without it.
    The texts are not read; the distinct failure patterns are few."""
    m = policy.mask
    patterns = (entries.select(F.col("failed_bits").bitwiseAND(F.lit(m)).alias("bits"))
                .groupBy("bits").agg(F.count(F.lit(1)).alias("n")))
    names = list(RULES)
    table = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).cast("long").alias("bit"))
                      for r in policy.rules])
    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0)).cast("long")
    rows = patterns.select("bits", "n", F.inline(table))
    rest = F.col("bits").bitwiseAND(F.lit(m).bitwiseXOR(F.col("bit")))
    return rows.groupBy("rule").agg(
        total(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("fail"),
        total(F.col("bits") == F.col("bit")).alias("fail_alone"),
        total(rest == 0).alias("kept_without"))

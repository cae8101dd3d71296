"""Validation of tab-separated JSON key/value lines.

A line is valid when it is blank, or when it has exactly one tab and both
sides parse as JSON. Otherwise the first failing test names the reason, in
the order: ``no_tab``, ``extra_tab``, ``bad_key``, ``bad_value``. Every bad
line is reported (the reference stops at the first); the caller keeps
whatever columns locate a line (file path, ids).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.json_check import fast_json_valid, json_valid
from tessera.functions.tokens import PY_WHITESPACE_CLASS

# The reasons decided without parsing; blank means only the
# characters Python's str.strip() removes (str.isspace).
NO_TAB = "no_tab"
EXTRA_TAB = "extra_tab"
BAD_KEY = "bad_key"
BAD_VALUE = "bad_value"
PY_SPACE = PY_WHITESPACE_CLASS


def check_kv_lines(df: DataFrame, col: str = "value", keep: Sequence[str] = (),
                   keep_valid: bool = False) -> DataFrame:
    """(keep..., line, reason) for every invalid line; with ``keep_valid``
    all lines, ``reason`` null for valid ones.

    Blank and tab tests are JVM expressions; the JSON test is settled
    JVM-side where the grammar allows (see
    :mod:`tessera.functions.json_check`) and by ``json.loads`` in an
    Arrow-batched pandas UDF otherwise."""
    parts = F.split(F.col(col), "\t", -1)
    staged = df.select(*[F.col(k) for k in keep], F.col(col).alias("line"), parts.alias("_p"))
    blank = F.col("line").rlike(f"^{PY_SPACE}*$")
    n = F.size("_p")
    check = F.col("line").isNotNull() & ~blank & (n == 2)
    key, value = F.get("_p", 0), F.get("_p", 1)
    # Only one-tab lines the JVM cannot settle reach Python, and a value
    # only when its key is not already known to be bad.
    key_ok = json_valid(key, check)
    value_ok = json_valid(value, check & F.coalesce(fast_json_valid(key), F.lit(True)))
    reason = (F.when(F.col("line").isNull() | blank, F.lit(None).cast("string"))
              .when(n == 1, F.lit(NO_TAB))
              .when(n > 2, F.lit(EXTRA_TAB))
              .when(~key_ok, F.lit(BAD_KEY))
              .when(~value_ok, F.lit(BAD_VALUE)))
    out = staged.select(*keep, "line", reason.alias("reason"))
    return out if keep_valid else out.filter(F.col("reason").isNotNull())

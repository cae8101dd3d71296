"""JSON validity exactly as Python's ``json.loads`` judges it.

Spark's own JSON parsing differs (``try_parse_json`` accepts ``1 2`` and
rejects ``NaN``), so the final word comes from ``json.loads`` in an
Arrow-batched pandas UDF. Most texts are settled before that, JVM-side and
exactly:

- *sure valid*: a number, a string without escapes or control characters,
  a literal, a flat list of those, or a flat object with such strings as
  keys and such scalars as values, within JSON whitespace;
- *sure invalid*: nothing but whitespace, a first character that cannot
  start any JSON value, or one that can only start a literal (``t f n N I``)
  when the text is not that literal.

Only the rest (nested values, escapes, near-misses) reach Python.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import ship_package

# Json.loads' whitespace and grammar pieces, as Java regexes
# (\z is the absolute end; $ would also match before a final line break).
_WS = "[ \\t\\n\\r]*"
_NUM = "-?(?:0|[1-9][0-9]*)(?:\\.[0-9]+)?(?:[eE][-+]?[0-9]+)?"
_STR = '"[^"\\\\\\x00-\\x1F]*"'
_LIT = "true|false|null|NaN|-?Infinity"
_SCALAR = f"(?:{_NUM}|{_STR}|{_LIT})"
# Java's regex engine recurses once per repetition of a group, but not for a
# possessive one (``*+``): long flat lists and objects need no stack.
_LIST = f"\\[{_WS}(?:{_SCALAR}(?:{_WS},{_WS}{_SCALAR})*+)?{_WS}\\]"
_MEMBER = f"{_STR}{_WS}:{_WS}{_SCALAR}"
_OBJECT = f"\\{{{_WS}(?:{_MEMBER}(?:{_WS},{_WS}{_MEMBER})*+)?{_WS}\\}}"
SURE_VALID = f"^{_WS}(?:{_SCALAR}|{_LIST}|{_OBJECT}){_WS}\\z"
# The literals are decided by the valid pattern, so a text that starts like
# one and is not it is invalid.
SURE_INVALID = '^[ \\t\\n\\r]*(?:[^-0-9{\\["\\s]|[\\x0B\\f]|\\z)'


def _is_json(text: str) -> bool:
    try:
        json.loads(text)
    except (ValueError, RecursionError):
        return False
    return True


def _valid_series(texts: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else _is_json(t) for t in texts], dtype="object")


def python_json_valid(text: Column) -> Column:
    """``json.loads`` verdict per row (null for null). The UDF is built on
    call, not at import, so workers can import this module freely. It is
    marked non-deterministic only so the optimizer does not copy it into a
    pushed-down filter and run Python twice."""
    from pyspark.sql import SparkSession
    active = SparkSession.getActiveSession()
    if active is not None:
        ship_package(active)
    return F.pandas_udf(_valid_series, T.BooleanType()).asNondeterministic()(text)


def fast_json_valid(text: Column) -> Column:
    """True / False where the JVM can decide exactly, else null."""
    return F.when(text.rlike(SURE_VALID), F.lit(True)).when(text.rlike(SURE_INVALID), F.lit(False))


def json_valid(text: Column, send: Column | None = None) -> Column:
    """Exact ``json.loads`` validity: the JVM verdict, else Python's.
    ``send`` (default: always) limits which undecided rows go to Python;
    rows not sent come back null."""
    fast = fast_json_valid(text)
    undecided = fast.isNull() if send is None else (fast.isNull() & send)
    return F.coalesce(fast, python_json_valid(F.when(undecided, text)))

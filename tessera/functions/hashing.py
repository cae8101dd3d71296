"""A stable bucket for typed keys, as a built-in expression.

``bucket = int(sha1("<salt>|<type>|<key>").hexdigest(), 16) mod n``, where
``<type>`` and ``<key>`` are the Python type name and ``str()`` text of the
key, so ``5`` and ``"5"`` land apart. The 160-bit digest is reduced without
big integers: fold its five 32-bit words, ``acc = (acc * 2^32 + word) mod n``,
exact in a long for n < 2^31.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The Python type texts that enter the hash.
TYPE_TEXT = {
    "str": "<class 'str'>",
    "int": "<class 'int'>",
    "bool": "<class 'bool'>",
    "list": "<class 'list'>",
}


# The characters Python's repr shows by an escape (Unicode
# "Other" and "Separator" classes except the ASCII space), and the three
# named escapes.
_NON_PRINTABLE = "[\\p{C}\\p{Z}&&[^ ]]"
_NAMED_ESCAPES = {"\t": "\\t", "\n": "\\n", "\r": "\\r"}


def _escape_char(ch: Column) -> Column:
    """Python's escape of one non-printable character: named, else
    ``\\xhh``, ``\\uhhhh`` or ``\\Uhhhhhhhh`` of its code point."""
    code = F.ascii(ch)
    hexed = F.lower(F.hex(code))
    out = (F.when(code < 0x100, F.concat(F.lit("\\x"), F.lpad(hexed, 2, "0")))
           .when(code < 0x10000, F.concat(F.lit("\\u"), F.lpad(hexed, 4, "0")))
           .otherwise(F.concat(F.lit("\\U"), F.lpad(hexed, 8, "0"))))
    for raw, named in _NAMED_ESCAPES.items():
        out = F.when(ch == F.lit(raw), F.lit(named)).otherwise(out)
    return out


def _py_str_repr(s: Column) -> Column:
    """Python ``repr`` of a string: single quotes unless the text holds a
    single quote and no double quote; backslashes, the chosen quote and
    non-printable characters are escaped."""
    esc = F.replace(s, F.lit("\\"), F.lit("\\\\"))
    # Non-printable characters are rare: only texts holding one pay for the
    # per-character pass.
    per_char = F.array_join(F.transform(F.split(esc, ""), lambda ch: F.when(
        ch.rlike(_NON_PRINTABLE), _escape_char(ch)).otherwise(ch)), "")
    esc = F.when(esc.rlike(_NON_PRINTABLE), per_char).otherwise(esc)
    use_double = F.contains(s, F.lit("'")) & ~F.contains(s, F.lit('"'))
    single = F.concat(F.lit("'"), F.replace(esc, F.lit("'"), F.lit("\\'")), F.lit("'"))
    double = F.concat(F.lit('"'), esc, F.lit('"'))
    return F.when(use_double, double).otherwise(single)


def _py_text(c: Column, dt: T.DataType, nested: bool) -> tuple[str, Column]:
    """(type name, Python ``str()`` text) for a column of type ``dt``;
    inside a list, elements use ``repr`` (strings quoted) and a null is
    ``None``. A null itself gives null."""
    if nested:
        name, text = _py_text_of(c, dt, True)
        return name, F.coalesce(text, F.lit("None"))
    return _py_text_of(c, dt, False)


def _py_text_of(c: Column, dt: T.DataType, nested: bool) -> tuple[str, Column]:
    if isinstance(dt, T.StringType):
        return "str", (_py_str_repr(c) if nested else c)
    if isinstance(dt, T.BooleanType):
        return "bool", F.when(c, F.lit("True")).when(~c, F.lit("False"))
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "int", c.cast("string")
    if isinstance(dt, T.ArrayType):
        elem_type = dt.elementType
        body = F.array_join(F.transform(c, lambda x: _py_text(x, elem_type, True)[1]), ", ")
        return "list", F.concat(F.lit("["), body, F.lit("]"))
    if isinstance(dt, T.StructType):
        # A struct stands for a list of mixed types, e.g. ["a", 7]: its
        # fields in order.
        items = [_py_text(c[f.name], f.dataType, True)[1] for f in dt.fields]
        return "list", F.when(c.isNotNull(), F.concat(F.lit("["), F.concat_ws(", ", *items), F.lit("]")))
    raise TypeError(f"stable_bucket: unsupported key type {dt.simpleString()}")


def stable_bucket(key: Column, key_type: T.DataType, salt: str, n: int) -> Column:
    """Bucket in ``[0, n)`` of ``key`` (a column of ``key_type``): string,
    integral, boolean, an array of those, or a struct standing for a list
    of mixed types. Nulls inside a list are ``None``, a null key has a null
    bucket. Floating-point keys are refused (Python and Java print them
    differently)."""
    if not 0 < n < 2**31:
        raise ValueError("n must be in [1, 2^31)")
    type_name, text = _py_text(key, key_type, False)
    digest = F.sha1(F.concat(F.lit(f"{salt}|{TYPE_TEXT[type_name]}|"), text).cast("binary"))
    acc = F.lit(0).cast("long")
    for i in range(5):
        word = F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")
        acc = (acc * F.lit(2**32) + word) % F.lit(n)
    return acc

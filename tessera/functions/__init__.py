"""Column-level building blocks: tokenising, hashing, JSON checks, and the
compensated-sum merge. All return ``Column`` expressions (JVM-side) except the
JSON check, which is an Arrow-batched pandas UDF."""

from tessera.functions.tokens import (  # noqa: F401
    WHITESPACE_CLASS, line_array, token_array, token_count,
)
from tessera.functions.hashing import stable_bucket  # noqa: F401

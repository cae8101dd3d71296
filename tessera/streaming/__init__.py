"""Stream sources for the line operators.

The reference has no streaming operators, and none are added here. The
text operators (word count, line-length sum, character pairs, token counts,
the key/value check) are plain DataFrame transformations, so they run
unchanged on a streaming DataFrame of lines; aggregating ones need the
``complete`` or ``update`` output mode.
"""

from tessera.streaming.text import read_text_stream  # noqa: F401

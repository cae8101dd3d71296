"""Sources (text lines, edge lists, tab-separated tables) and sinks (tuple
text, CSV)."""

from tessera.sources.text import (  # noqa: F401
    parse_edges, parse_tsv, read_lines, read_numbered_lines, read_tsv,
)
from tessera.sources.sinks import write_csv, write_tuple_text, write_value_text  # noqa: F401

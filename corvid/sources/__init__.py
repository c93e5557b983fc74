"""Sources and sinks."""

from corvid.sources.sinks import read_in_order, write_delimited, write_lines  # noqa: F401
from corvid.sources.text import (  # noqa: F401
    REJECTS,
    observe_rejects,
    parse_adjacency,
    parse_cells,
    parse_edges,
    parse_links,
    parse_ratings,
    read_adjacency,
    read_cells,
    read_lines,
    read_links,
    read_ratings,
    strip_headers,
)

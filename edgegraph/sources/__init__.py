"""Sources: parquet tables, the edge views derived from them, and text-line decoders."""

from edgegraph.sources.tables import load_table, TABLES  # noqa: F401
from edgegraph.sources.views import (  # noqa: F401
    txn_edges, user_edges, signed_edges, cust_edges, edge_lines,
)
from edgegraph.sources.text import (  # noqa: F401
    parse_pairs, parse_txn, parse_signed, parse_timed, parse_ratings, read_edge_text, decode, FORMATS,
)

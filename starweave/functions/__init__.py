"""Column-level functions (Column -> Column), all Spark built-ins."""

from starweave.functions.dates import (
    date_text,
    elapsed_days,
    elapsed_seconds,
    parse_ts,
    to_date_lenient,
)
from starweave.functions.hashing import hash_int, hash_mod, hash60
from starweave.functions.text import (
    first_matching,
    html_text_nodes,
    normalize_key,
    strip_ws,
    unescape_html,
)

__all__ = [
    "date_text", "elapsed_days", "elapsed_seconds", "parse_ts", "to_date_lenient",
    "hash_int", "hash_mod", "hash60",
    "first_matching", "html_text_nodes", "normalize_key", "strip_ws", "unescape_html",
]

"""Seeded, key-based pseudo-random numbers (portable: md5 hex digits).

The reference draws unseeded random numbers; we derive them from a hash of
(seed, tag, row key) so a run is repeatable and independent of partitioning.
md5 is used because its hex digits are identical in every SQL engine, which
lets the DuckDB oracle reproduce the same values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _key_text(seed, tag: str, *cols) -> Column:
    parts = [F.lit(f"{seed}:{tag}:" if tag else f"{seed}:")]
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("|"))
        parts.append(F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), F.lit("")))
    return F.concat(*parts)


def hash_int(seed, tag: str, *cols, hex_digits: int = 8) -> Column:
    """Non-negative integer from the first ``hex_digits`` hex digits of md5."""
    return F.conv(F.substring(F.md5(_key_text(seed, tag, *cols)), 1, hex_digits), 16, 10).cast("bigint")


def hash60(seed, *cols) -> Column:
    """60-bit uniform integer; used as a sort key for seeded exact sampling."""
    return hash_int(seed, "", *cols, hex_digits=15)


def hash_mod(seed, tag: str, n: int, *cols) -> Column:
    """Uniform integer in [0, n) from (seed, tag, key)."""
    return F.pmod(hash_int(seed, tag, *cols), F.lit(n)).cast("bigint")

"""Row counts and shapes as run checks (A4, A5).

Counts are taken with an ``Observation`` while the output is written, not by
a second job over the same plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def shape(df: DataFrame, name: str) -> DataFrame:
    """(table_name, n_rows, n_columns) as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"), F.col("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_columns")
    )


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row-count observation; read ``obs.get`` after the action."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_observed(df: DataFrame, write: Callable[[DataFrame], None], name: str = "write") -> dict:
    """Run ``write`` once and return the rows counted during it."""
    tagged, obs = observed(df, name)
    write(tagged)
    return dict(obs.get)

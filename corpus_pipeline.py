"""The corpus pipeline: language ID, near-duplicates, decontamination, secrets, packing.

Each stage works on all rows that its predecessor kept; its result is written as
Parquet and read again, so a lost executor or driver costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starweave.llm.common import save, table
from starweave.llm.decontaminate import drop_contaminated
from starweave.llm.language_id import keep_known
from starweave.llm.packing import pack_stage
from starweave.llm.secrets import mask_secrets
from starweave.llm.simhash import keep_one

STAGES = [
    ("language_id", keep_known),
    ("simhash_dedup", keep_one),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack_stage),
]

#: The classifier and the dynamic programme have no SQL form; tests hold run() against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), name)
    return docs

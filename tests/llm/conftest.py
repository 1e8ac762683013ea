from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents rows from (doc_id, text[, lang[, source]])."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def rows_of():
    """The given rows of a table, as dicts, read without Spark."""

    def read(name, sf=SF):
        res = duckdb.execute(f"SELECT * FROM read_parquet('{sf}/{name}.parquet')")
        names = [c[0] for c in res.description]
        return [dict(zip(names, r)) for r in res.fetchall()]

    return read

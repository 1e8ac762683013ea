"""Secret scans with corpus-wide ownership frequency.

Candidates are the three base kinds (assignments, access keys, hexadecimal runs)
and, added by the method, bare tokens: runs of 20 or more of `A-Za-z0-9_-` that
mix digits with letters and look random. Each candidate value is hashed, and for
each hash the corpus is asked how many repositories (documents) and how many
owners (sources) hold it. A value is a widely copied example if at least
``EXAMPLE_OWNERS`` owners hold it, or if ``EXAMPLE_REPOS`` repositories do and no owner
has more than ``OWNER_SHARE`` of them; any other is specific to its owners and looks live.
Base spans are always reported; a bare token only if its value looks live.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweave.llm.common import BROADCAST_ROWS, add_columns, map_batches, save, texts, unused, with_named
from starweave.operators.joins import hot_keys, lookup_join

EXAMPLE_OWNERS = 3
EXAMPLE_REPOS, OWNER_SHARE = 20, 0.75
TOKEN_CHARS, TOKEN_BITS = 20, 3.5  # least length of a bare token, least entropy per character
KINDS = ("assign", "access", "hex", "token")
MASK = "[SECRET]"
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_KEYWORDS = ("passw", "secret", "token", "api")
# Access keys, hexadecimal runs and bare tokens all lie inside such a run.
_RUN = re.compile(r"[A-Za-z0-9_-]{16,}")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")


def looks_random(run: str) -> bool:
    if len(run) < TOKEN_CHARS or run.isalpha() or not any(c.isdigit() for c in run) or not any(c.isalpha() for c in run):
        return False
    n = len(run)
    return -sum(c / n * math.log2(c / n) for c in Counter(run).values()) >= TOKEN_BITS


def candidates(text: str | None) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, value) in code points, ordered by start, then kind."""
    if not text:
        return []
    out = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        out += [(0, m.start(), m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    runs = []
    for r in _RUN.finditer(text):
        run, at = r[0], r.start()
        if "AKIA" in run:
            out += [(1, at + m.start(), at + m.end(), m[0]) for m in _ACCESS.finditer(run) if len(m[0]) >= 16]
        if len(run) >= 32:
            out += [(2, at + m.start(), at + m.end(), m[0]) for m in _HEX.finditer(run)]
        if looks_random(run):
            runs.append((3, at, at + len(run), run))
    if runs:
        base = sorted((s, e) for _, s, e, _ in out)
        starts = [s for s, _ in base]
        from bisect import bisect_left

        # maximal spans, so the last one that begins before the run's end decides
        reach, best = [], -1
        for _, e in base:
            best = max(best, e)
            reach.append(best)
        for k, s, e, v in runs:
            i = bisect_left(starts, e)
            if not i or reach[i - 1] <= s:
                out.append((k, s, e, v))
    return sorted(out)


def _line(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


_SPAN = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()), T.StructField("value", T.StringType())])


def scanned(docs: DataFrame, owner: str = "source", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: row, id, owner, key (hash of the text) and its candidates, values hashed."""

    def run(b):
        rows = []
        for t in texts(b):
            found = sorted(candidates(t), key=lambda x: (x[1], x[0]))
            rows.append([{"kind": k, "start": s, "stop": e, "value": hashlib.sha256(v.encode()).hexdigest()[:32]} for k, s, e, v in found])
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("value", pa.string())]))
        return [pa.array(rows, kind)]

    rows = docs.select(F.col(doc_id).alias("id"), F.col(owner).alias("owner"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("key"), F.col(text).alias("text"))
    found = add_columns(rows, [T.StructField("spans", T.ArrayType(_SPAN))], run, keep=["id", "owner", "key"])
    return save(found.withColumn("row", F.monotonically_increasing_id()), "secrets")


def ownership(rows: DataFrame, example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS, owner_share: float = OWNER_SHARE) -> DataFrame:
    """(value, n_repos, n_owners, live) for every candidate value.

    Rows without an owner are one owner's, and rows of an owner without an id are one repository.
    """
    each = rows.where(F.size("spans") > 0).select("id", "owner", F.explode("spans.value").alias("value")).distinct()
    # a repository belongs to one owner here, so repositories add up over owners
    repos = each.groupBy("value", "owner").agg(F.count("*").alias("n"))
    sums = repos.groupBy("value").agg(F.sum("n").alias("n_repos"), F.count("*").alias("n_owners"), F.max("n").alias("most"))
    example = (F.col("n_owners") >= example_owners) | ((F.col("n_repos") >= example_repos) & (F.col("most") <= owner_share * F.col("n_repos")))
    return sums.select("value", "n_repos", "n_owners", (~example).alias("live"))


def reported(rows: DataFrame) -> DataFrame:
    """(row, all_spans, n_live, n_example, max_repos, max_owners) for rows with candidates: base spans, and tokens that look live.

    Values of one repository, most of them, are live and need no join; the others are
    broadcast if counted to be few, else the common ones are salted.
    """
    each = rows.select("row", F.explode("spans").alias("s")).select("row", "s.*")
    shared = save(ownership(rows).where("n_repos > 1").withColumnRenamed("value", "_sw_value"), "secret-owners")
    small = shared.count() <= BROADCAST_ROWS
    hot = None if small else hot_keys(each, {"value": ["value"]})["value"]
    each = lookup_join(each, shared, [("value", "_sw_value")], "left", small, hot)
    live = F.coalesce("live", F.lit(True))
    kept = F.when((F.col("kind") < 3) | live, F.struct("start", "kind", "stop"))
    return each.groupBy("row").agg(
        F.array_sort(F.collect_list(kept)).alias("all_spans"),
        F.count_if(live).alias("n_live"),
        F.count_if(~live).alias("n_example"),
        F.max(F.coalesce("n_repos", F.lit(1))).alias("max_repos"),
        F.max(F.coalesce("n_owners", F.lit(1))).alias("max_owners"),
    )


def _text(spans) -> F.Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ",")


def query(docs: DataFrame) -> DataFrame:
    """op9: per row of documents, with the most repositories and owners that one of its values has.

    Null and empty texts have no spans, repeated rows each get a row (and are one
    repository), very long texts are scanned whole, further columns go, and a table
    without rows gives none.
    """
    rows = scanned(docs.select("doc_id", "source", "text"))
    base = F.filter("spans", lambda s: s["kind"] < 3)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    out = rows.join(reported(rows), "row", "left")
    return out.select(
        F.col("id").alias("doc_id"),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_text(base), 256).alias("base_sha256"),
        F.coalesce(_text(F.col("all_spans")), F.lit("")).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_example", F.lit(0)).alias("n_example"),
        F.coalesce("max_repos", F.lit(0)).alias("max_repos"),
        F.coalesce("max_owners", F.lit(0)).alias("max_owners"),
    )


def masked(text: str, spans: list[tuple[int, int]]) -> str:
    out, at = [], 0
    for s, e in sorted(spans):
        if s >= at:
            out += [text[at:s], MASK]
        at = max(at, e)
    return "".join([*out, text[at:]])


def mask_secrets(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every reported span is replaced by ``MASK`` and n_chars, which documents must have, follows; no document goes."""
    rows = scanned(docs.select("doc_id", "source", "text"))
    spans = rows.select("row", "id", "key").join(reported(rows), "row").where(F.size("all_spans") > 0)
    spans = spans.groupBy("id", "key").agg(F.first("all_spans").alias("all_spans"))
    key, cut, id_ = unused(docs, "text_key"), unused(docs, "cut"), unused(docs, "cut_id")
    spans = spans.select(F.col("id").alias(id_), F.col("key").alias(key), F.col("all_spans").alias(cut))
    rows = with_named(docs, spans, id_, key, cut)
    at_text, at_n = docs.columns.index("text"), docs.columns.index("n_chars")
    schema = T.StructType(docs.schema.fields)

    def run(batches):
        for b in batches:
            spans = b.column(b.num_columns - 1).to_pylist()
            if not any(spans):
                yield pa.RecordBatch.from_arrays(b.columns[:-1], names=schema.names)
                continue
            old, n = b.column(at_text).to_pylist(), b.column(at_n).to_pylist()
            new = [masked(t, [(s["start"], s["stop"]) for s in x]) if x else t for t, x in zip(old, spans)]
            cols = list(b.columns[:-1])
            cols[at_text] = pa.array(new, b.column(at_text).type)
            cols[at_n] = pa.array([len(t) if x else c for t, x, c in zip(new, spans, n)], b.column(at_n).type)
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return map_batches(rows, run, schema)

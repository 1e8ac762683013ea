"""DuckDB SQL of the queries that SQL can express; the others are tested against plain Python."""

from __future__ import annotations

_SPACE_WORD = r"'[^\x20\x09-\x0D]+'"
_BENCH_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Fixed value: the pattern of assignments.
_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# Matches of each kind and the texts between them, whose lengths give the places.
_PIECES = "\n    UNION ALL ".join(
    f"SELECT row, {kind} AS kind, {least} AS least_n, {_sql(rx)} AS rx, regexp_extract_all(text, {_sql(rx)}) AS m, string_split_regex(text, {_sql(rx)}) AS p FROM d"
    for kind, rx, least in ((0, _ASSIGN, 8), (1, "AKIA[A-Z0-9]+", 16), (2, "[0-9a-f]+", 32), (3, "[A-Za-z0-9_-]+", 20))
)

ORACLE: dict[str, str] = {
    # for pages that mark their article, with the tags and character references of the test pages
    "op1_main_text": r"""
WITH a AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS body FROM pages
), b AS (
  SELECT page_id, url, string_split_regex(replace(regexp_replace(body, '</?b>', '', 'g'), '<br>', ' '), '</?(?:h1|p)>') AS parts FROM a
), c AS (
  SELECT page_id, url, array_to_string(list_filter(list_transform(parts, lambda x: trim(regexp_replace(regexp_replace(
    replace(replace(replace(x, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))), lambda x: x <> ''), chr(10)) AS text
  FROM b
)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM c
""",
    "op2_exact_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op4_token_counts": f"""
WITH d AS (
  SELECT source, lang, len(regexp_extract_all(coalesce(text, ''), {_SPACE_WORD})) AS words,
         CAST(ceil(octet_length(encode(coalesce(text, ''))) / 4.0) AS BIGINT) AS pieces,
         text IS NULL OR row_number() OVER (PARTITION BY text ORDER BY doc_id NULLS FIRST) = 1 AS stays
  FROM documents
), c AS (
  SELECT source, lang, 'words-2' AS tokenizer, words AS n FROM d WHERE stays
  UNION ALL SELECT source, lang, 'pieces-1', pieces FROM d WHERE stays
)
SELECT source, lang, tokenizer, CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens
FROM c GROUP BY ALL
""",
    "op6_decontamination": f"""
WITH i AS (
  SELECT item_id, regexp_extract_all({_LOWER}, {_BENCH_WORD}) AS w FROM benchmark
), g AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(len(w), 10) AS n, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS gram
  FROM i, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(p) WHERE len(w) > 0
), d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_LOWER}, {_BENCH_WORD}) AS w FROM documents
), k AS (
  SELECT DISTINCT n FROM g
), s AS (
  SELECT row, n, p, array_to_string(w[p : p + n - 1], ' ') AS gram
  FROM d, k, unnest(range(1, len(w) - n + 2)) AS t(p) WHERE len(w) >= n
), h AS (
  SELECT s.row, s.p, s.n, g.item FROM s JOIN g ON s.gram = g.gram AND s.n = g.n
), covered AS (
  SELECT row, count(DISTINCT x) AS n_hit FROM h, unnest(range(p, p + n)) AS t(x) GROUP BY row
), named AS (
  SELECT row, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY row
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (row) LEFT JOIN named USING (row)
""",
    # up to 50,000 documents a bucket, where a bucket is one shard
    "op3_length_buckets": f"""
WITH RECURSIVE d AS (
  SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), {_SPACE_WORD})) AS BIGINT) AS n_tokens FROM documents
), q AS (
  SELECT *, 2.0 ** (floor(log2(greatest(n_tokens, 1))) - 8) AS fine FROM d
), b AS (
  SELECT row_number() OVER (ORDER BY max(n_tokens)) AS j, max(n_tokens) AS top, count(*) AS n, sum(n_tokens) AS total
  FROM q GROUP BY ceil(n_tokens / greatest(fine, 1.0)), greatest(fine, 1.0)
), c AS (
  SELECT 0 AS j, 0 AS top, 0 AS n, 0 AS total
  UNION ALL SELECT j, top, sum(n) OVER (ORDER BY j), sum(total) OVER (ORDER BY j) FROM b
), pad AS (  -- padding of a bucket over the bins after i up to j
  SELECT lo.j AS i, hi.j AS j, hi.top * (hi.n - lo.n) - (hi.total - lo.total) AS cost FROM c lo JOIN c hi ON lo.j < hi.j
), dp AS (
  SELECT 1 AS k, j, cost, CAST(0 AS BIGINT) AS i FROM pad WHERE i = 0
  UNION ALL
  SELECT dp.k + 1, pad.j, min(dp.cost + pad.cost), arg_min(pad.i, struct_pack(c := dp.cost + pad.cost, i := pad.i))
  FROM dp JOIN pad ON pad.i = dp.j
  WHERE dp.k < (SELECT least(12, count(*)) FROM b) AND dp.j >= dp.k GROUP BY dp.k, pad.j
), cut AS (
  SELECT k, j, i FROM dp WHERE k = (SELECT least(12, count(*)) FROM b) AND j = (SELECT count(*) FROM b)
  UNION ALL
  SELECT dp.k, dp.j, dp.i FROM cut JOIN dp ON dp.k = cut.k - 1 AND dp.j = cut.i
), ends AS (
  SELECT cut.k - 1 AS bucket, CAST(b.top AS BIGINT) AS bucket_len FROM cut JOIN b ON cut.j = b.j
), placed AS (
  SELECT d.*, e.bucket, e.bucket_len, row_number() OVER (PARTITION BY e.bucket ORDER BY doc_id) - 1 AS place,
         greatest(1, 65536 // greatest(1, e.bucket_len)) AS per_batch
  FROM d ASOF JOIN ends e ON d.n_tokens <= e.bucket_len
)
SELECT doc_id, n_tokens, CAST(bucket AS INTEGER) AS bucket, bucket_len, bucket_len - n_tokens AS padding, CAST(0 AS BIGINT) AS shard,
       place // per_batch AS batch, place % per_batch AS slot
FROM placed
""",
    "op9_secrets": f"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(source, '') AS owner, coalesce(text, '') AS text FROM documents
), kinds(kind, name, rx, least_n) AS (
  VALUES (0, 'assign', {_sql(_ASSIGN)}, 8), (1, 'access', 'AKIA[A-Z0-9]+', 16), (2, 'hex', '[0-9a-f]+', 32), (3, 'token', '[A-Za-z0-9_-]+', 20)
), pieces AS (
  SELECT row, kind, least_n, rx, m, p FROM (
    {_PIECES}
  )
), found AS (
  SELECT row, kind, least_n, rx, unnest(m) AS hit, unnest(range(1, len(m) + 1)) AS nth, m, p FROM pieces WHERE len(m) > 0
), spans AS (
  SELECT row, kind, least_n, CASE WHEN kind = 0 THEN regexp_extract(hit, rx, 2) ELSE hit END AS value,
         CAST(list_sum(list_transform(list_slice(p, 1, nth), lambda x: length(x))) + coalesce(list_sum(list_transform(list_slice(m, 1, nth - 1), lambda x: length(x))), 0) AS BIGINT) AS first,
         length(hit) AS n
  FROM found WHERE length(hit) >= least_n
), base AS (
  SELECT row, kind, value, first, first + n AS stop FROM spans WHERE kind < 3 AND length(value) >= least_n
), tokens AS (
  SELECT row, kind, value, first, first + n AS stop FROM spans s
  WHERE kind = 3 AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
    AND (SELECT -sum(k / length(value) * log2(k / length(value)))
         FROM (SELECT count(*) AS k FROM (SELECT unnest(string_split(value, '')) AS ch) GROUP BY ch)) >= 3.5
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.row = s.row AND b.first < s.first + s.n AND b.stop > s.first)
), every AS (
  SELECT * FROM base UNION ALL SELECT * FROM tokens
), repos AS (
  SELECT value, owner, count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), '')) AS n FROM every JOIN d USING (row) GROUP BY value, owner
), owners AS (
  SELECT value, CAST(sum(n) AS BIGINT) AS n_repos, count(*) AS n_owners, NOT (count(*) >= 3 OR (sum(n) >= 20 AND max(n) <= 0.75 * sum(n))) AS live
  FROM repos GROUP BY value
), shown AS (
  SELECT row, string_agg(CASE WHEN kind < 3 OR live THEN name || ':' || first || ':' || stop END, ',' ORDER BY first, kind) AS spans,
         string_agg(CASE WHEN kind < 3 THEN name || ':' || first || ':' || stop END, ',' ORDER BY first, kind) AS base,
         count_if(kind = 0) AS n_assign, count_if(kind = 1) AS n_access, count_if(kind = 2) AS n_hex,
         count_if(live) AS n_live, count_if(NOT live) AS n_example, max(n_repos) AS max_repos, max(n_owners) AS max_owners
  FROM every JOIN owners USING (value) JOIN kinds USING (kind) GROUP BY row
)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
       CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       CAST(coalesce(n_live, 0) AS BIGINT) AS n_live, CAST(coalesce(n_example, 0) AS BIGINT) AS n_example,
       CAST(coalesce(max_repos, 0) AS BIGINT) AS max_repos, CAST(coalesce(max_owners, 0) AS BIGINT) AS max_owners
FROM d LEFT JOIN shown USING (row)
""",
    "op10_suffix_dedup": """
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, encode(coalesce(text, '')) AS x FROM documents
), w AS (
  SELECT row, p, md5(x[p + 1 : p + 200]) AS s FROM d, unnest(range(0, octet_length(x) - 199)) AS t(p)
), again AS (
  SELECT row, p FROM w SEMI JOIN (SELECT s FROM w GROUP BY s HAVING count(*) > 1) r ON w.s = r.s
), runs AS (
  SELECT row, min(p) AS first, max(p) + 200 AS stop
  FROM (SELECT row, p, sum(fresh) OVER (PARTITION BY row ORDER BY p) AS run
        FROM (SELECT row, p, CASE WHEN p - lag(p) OVER (PARTITION BY row ORDER BY p) <= 200 THEN 0 ELSE 1 END AS fresh FROM again))
  GROUP BY row, run
), gaps AS (  -- what is kept before each run
  SELECT row, first, stop, coalesce(lag(stop) OVER (PARTITION BY row ORDER BY first), 0) AS since FROM runs
), cut AS (
  SELECT row, sum(stop - first) AS n_removed, count(*) AS n_spans, max(stop) AS last,
         string_agg(hex(x[since + 1 : first]), '' ORDER BY first) AS before
  FROM gaps JOIN d USING (row) GROUP BY row
)
SELECT doc_id, CAST(octet_length(x) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(before, '')) || x[CAST(coalesce(last, 0) AS BIGINT) + 1 : octet_length(x)]) AS kept_sha256
FROM d LEFT JOIN cut USING (row)
""",
}

"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the Spark code as plain SQL over the driver's
tables (views ``orders``, ``lineitem`` ...). Shared pieces are CTE texts.
"""

from __future__ import annotations

from html.entities import name2codepoint

LOAD_TS = "TIMESTAMP '2024-01-01 00:00:00'"
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
BOOLS = ["ih_program_declared", "ia_program_declared", "pa_program_declared", "hm_program_declared"]


def h(seed, tag: str, cols, digits: int = 8) -> str:
    prefix = f"{seed}:{tag}:" if tag else f"{seed}:"
    parts = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols)
    return f"('0x' || substr(md5('{prefix}' || {parts}), 1, {digits}))::BIGINT"


def h60(seed, cols) -> str:
    return h(seed, "", cols, 15)


def split_rank(table: str, key: list[str], seed, frac: float, flag: str = "is_test") -> str:
    order = ", ".join(["_h", *key])
    return (
        f"SELECT * EXCLUDE (_h), row_number() OVER (ORDER BY {order}) <= round_even(count(*) OVER () * {frac}, 0) AS {flag} "
        f"FROM (SELECT *, {h60(seed, key)} AS _h FROM {table})"
    )


def elapsed_days(b: str, e: str) -> str:
    return f"CAST(floor(date_diff('second', {b}, {e}) / 86400.0) AS BIGINT)"


LINE_DURATION = (
    f"CAST(CASE WHEN {elapsed_days('o_orderdate', 'l_shipdate')} = 0 "
    f"THEN 1 + {h(1, 'incident_duration', LINE_KEY)} % 24 "
    f"ELSE {elapsed_days('o_orderdate', 'l_shipdate')} * 24 END AS INTEGER)"
)
MESSY_COUNTY = "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'unknown' ELSE '  ' || lower(c_name) || ' ' END"

BASE = f"""
osplit AS ({split_rank('orders', ['o_orderkey'], 1, 0.2)}),
lines AS (SELECT l.*, o.o_custkey, o.o_orderstatus, o.o_orderpriority, o.o_orderdate, o.is_test
          FROM lineitem l JOIN osplit o ON l.l_orderkey = o.o_orderkey),
cust AS (SELECT c.*, n.n_name FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)
"""


def first_per_key(src: str, keys: list[str], attrs: list[str]) -> str:
    order = ", ".join(["src"] + [f"{a} ASC NULLS LAST" for a in attrs])
    knn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return (
        f"SELECT * EXCLUDE (rn, src) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) AS rn "
        f"FROM {src} WHERE {knn}) WHERE rn = 1"
    )


def dimension(name: str, one: str, tk: str, keys: list[str], cols: list[str], unknown: dict[str, str]) -> str:
    """CTEs ``{name}_one`` (deduped) and ``{name}`` (keyed + SCD + UNKNOWN)."""
    unk = ", ".join(unknown.get(c, "NULL") + f" AS {c}" for c in cols)
    return f"""
{name} AS (
  SELECT CAST(0 AS BIGINT) AS {tk}, 1 AS version, {LOAD_TS} AS date_from, CAST(NULL AS TIMESTAMP) AS date_to, {unk}
  UNION ALL BY NAME
  SELECT row_number() OVER (ORDER BY {', '.join(keys)}) AS {tk}, 1 AS version, {LOAD_TS} AS date_from,
         CAST(NULL AS TIMESTAMP) AS date_to, {', '.join(cols)}
  FROM {one})"""


DECL_SRC = """
decl_src AS (
  SELECT o_orderkey AS declaration_request_number, o_orderpriority AS declaration_title, o_orderstatus AS declaration_type,
         CAST(o_orderdate AS DATE) AS declaration_date, 0 AS src FROM osplit WHERE NOT is_test
  UNION ALL
  SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE l_orderkey END,
         CASE WHEN l_linenumber = 1 THEN lower(o_orderpriority) ELSE nullif(o_orderpriority, '4-NOT SPECIFIED') END,
         o_orderstatus, CAST(o_orderdate AS DATE), 1 FROM lines WHERE is_test)"""

DECL_DIM = (
    DECL_SRC
    + ",\ndecl_one AS ("
    + first_per_key("decl_src", ["declaration_request_number"], ["declaration_title", "declaration_type", "declaration_date"])
    + "),"
    + dimension(
        "declaration_dim", "decl_one", "declaration_tk", ["declaration_request_number"],
        ["declaration_title", "declaration_type", "declaration_date", "declaration_request_number"],
        {"declaration_title": "CAST(NULL AS VARCHAR)", "declaration_type": "CAST(NULL AS VARCHAR)",
         "declaration_date": "CAST(NULL AS DATE)", "declaration_request_number": "CAST(NULL AS BIGINT)"},
    )
)

DIS_SRC = """
dis_src AS (
  SELECT p_partkey AS disaster_number, p_type AS incident_type,
         TRY_CAST(p_size % 2 AS BOOLEAN) AS ih_program_declared,
         TRY_CAST(CAST(p_size > 25 AS INTEGER) AS BOOLEAN) AS ia_program_declared,
         TRY_CAST(CAST(p_retailprice > 1500 AS INTEGER) AS BOOLEAN) AS pa_program_declared,
         TRY_CAST(CAST(p_brand = 'Brand#1' AS INTEGER) AS BOOLEAN) AS hm_program_declared, 0 AS src
  FROM part WHERE p_size <= 45
  UNION ALL
  SELECT l_partkey, CASE WHEN l_linenumber % 2 = 0 THEN lower(p_type) ELSE p_type END,
         TRY_CAST(CASE WHEN p_size % 2 = 1 THEN 'true' ELSE 'false' END AS BOOLEAN),
         TRY_CAST(CASE WHEN p_size > 25 THEN '1' ELSE '0' END AS BOOLEAN),
         TRY_CAST(CASE WHEN l_returnflag = 'R' THEN 'unknown' WHEN p_retailprice > 1500 THEN 'true' ELSE 'false' END AS BOOLEAN),
         TRY_CAST(CASE WHEN p_brand = 'Brand#1' THEN '1' ELSE '0' END AS BOOLEAN), 1
  FROM lines JOIN part ON l_partkey = p_partkey WHERE is_test)"""

DIS_DIM = (
    DIS_SRC
    + ",\ndis_one AS ("
    + first_per_key("dis_src", ["disaster_number"], ["incident_type", *BOOLS])
    + "),"
    + dimension(
        "disaster_dim", "dis_one", "disaster_tk", ["disaster_number"], ["disaster_number", "incident_type", *BOOLS],
        {"disaster_number": "CAST(NULL AS BIGINT)", "incident_type": "CAST(NULL AS VARCHAR)", **{b: "false" for b in BOOLS}},
    )
)

DATES_SRC = f"""
dates_src AS (
  SELECT CAST(o_orderdate AS DATE) AS incident_begin_date, CAST(l_shipdate AS DATE) AS incident_end_date,
         CAST(coalesce(CASE WHEN is_test AND l_returnflag = 'N' THEN NULL ELSE {LINE_DURATION} END,
                       date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) * 24) AS INTEGER) AS incident_duration,
         CASE WHEN is_test THEN 1 ELSE 0 END AS src
  FROM lines)"""

DATES_DIM = (
    DATES_SRC
    + ",\ndates_one AS ("
    + first_per_key("dates_src", ["incident_begin_date", "incident_end_date"], ["incident_duration"])
    + "),"
    + dimension(
        "dates_dim", "dates_one", "incident_dates_tk", ["incident_begin_date", "incident_end_date"],
        ["incident_begin_date", "incident_end_date", "incident_duration"],
        {"incident_begin_date": "CAST(NULL AS DATE)", "incident_end_date": "CAST(NULL AS DATE)", "incident_duration": "0"},
    )
)

STATE_SRC = f"""
state_src AS (
  SELECT upper(trim(n_name)) AS state_name, upper(trim(c_name)) AS country_name, 0 AS src FROM cust
  UNION ALL
  SELECT upper(trim(lower(n_name))), upper(trim({MESSY_COUNTY})), 1
  FROM lines JOIN cust ON o_custkey = c_custkey WHERE is_test)"""

STATE_DIM = (
    STATE_SRC
    + ",\nstate_one AS (SELECT * FROM ("
    + first_per_key("state_src", ["country_name"], ["state_name"])
    + ") WHERE country_name IS DISTINCT FROM 'UNKNOWN'),"
    + dimension(
        "state_dim", "state_one", "state_tk", ["country_name"], ["state_name", "country_name"],
        {"state_name": "'UNKNOWN'", "country_name": "'UNKNOWN'"},
    )
)

STAGING_DB = """
staging_db AS (
  SELECT trim(c.c_name) AS country_name, trim(c.n_name) AS state, l.l_partkey AS disaster_number,
         d.o_orderkey AS declaration_request_number, CAST(d.o_orderdate AS DATE) AS incident_begin_date,
         CAST(l.l_shipdate AS DATE) AS incident_end_date, CAST(l.l_quantity AS INTEGER) AS deaths
  FROM (SELECT * FROM lines WHERE NOT is_test) l
  LEFT JOIN (SELECT o_orderkey, o_custkey, o_orderdate FROM osplit WHERE NOT is_test) d ON l.l_orderkey = d.o_orderkey
  LEFT JOIN cust c ON d.o_custkey = c.c_custkey)"""

STAGING = STAGING_DB + f""",
staging AS (
  SELECT * FROM staging_db
  UNION ALL
  SELECT trim({MESSY_COUNTY}), trim(lower(n_name)), l_partkey,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE l_orderkey END,
         CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE), CAST(l_quantity AS INTEGER)
  FROM lines JOIN cust ON o_custkey = c_custkey WHERE is_test)"""

RESOLVED = """
resolved AS (
  SELECT coalesce(s.state_tk, 0) AS state_tk, coalesce(di.disaster_tk, 0) AS disaster_tk,
         coalesce(dc.declaration_tk, 0) AS declaration_tk, coalesce(dt.incident_dates_tk, 0) AS incident_dates_tk,
         f.deaths, f.country_name, f.disaster_number, f.declaration_request_number, f.incident_begin_date, f.incident_end_date
  FROM staging f
  LEFT JOIN state_dim s ON upper(trim(f.country_name)) = upper(trim(s.country_name))
  LEFT JOIN disaster_dim di ON f.disaster_number = di.disaster_number
  LEFT JOIN declaration_dim dc ON f.declaration_request_number = dc.declaration_request_number
  LEFT JOIN dates_dim dt ON f.incident_begin_date = dt.incident_begin_date AND f.incident_end_date = dt.incident_end_date)"""

FACT = """
fact AS (
  SELECT state_tk, disaster_tk, declaration_tk, incident_dates_tk, deaths,
         row_number() OVER (ORDER BY state_tk, disaster_tk, declaration_tk, incident_dates_tk, deaths NULLS FIRST) AS disaster_fact_tk
  FROM resolved)"""

ALL_DIMS = ",".join([DECL_DIM, DIS_DIM, DATES_DIM, STATE_DIM])


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ",".join([BASE, *ctes]) + "\n" + select


# ------------------------------------------------------------------ per-query SQL

ISO = "%Y-%m-%dT%H:%M:%SZ"
WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NON_TEXT = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
CARD = r"(?is)<li\b[^>]*>(.*?)</li\s*>"
ANCHOR = r"""(?is)<a\b[^>]*?\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)[^>]*>(.*?)</a\s*>"""
QUOTES = r"""^["']|["']$"""
REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
NAMED = "MAP {" + ", ".join(f"'{n}': chr({c})" for n, c in sorted(name2codepoint.items())) + "}"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, {q('^' + WS + '+|' + WS + '+$')}, '', 'g')"


def unescape_sql(x: str) -> str:
    name = f"regexp_extract(p, {q(REFERENCE)}, 1)"
    code = f"TRY_CAST(CASE WHEN {name} ILIKE '#x%' THEN '0x' || substr({name}, 3) ELSE substr({name}, 2) END AS INTEGER)"
    char = f"CASE WHEN {code} BETWEEN 1 AND 55295 OR {code} BETWEEN 57344 AND 1114111 THEN chr({code}) END"
    char = f"CASE WHEN {name} LIKE '#%' THEN {char} ELSE element_at({NAMED}, {name})[1] END"
    piece = f"coalesce({char} || substr(p, length({name}) + 2), '&' || p)"
    cut = f"string_split({x}, '&')"
    return f"({cut}[1] || coalesce(array_to_string(list_transform({cut}[2:], lambda p: {piece}), ''), ''))"


def text_nodes_sql(x: str) -> str:
    parts = f"regexp_split_to_array(regexp_replace({x}, {q(NON_TEXT)}, '<>', 'g'), '<[^>]*>')"
    return f"list_filter(list_transform({parts}, lambda s: {strip_sql(unescape_sql('s'))}), lambda s: s <> '')"


def first_match_sql(arr: str, needle: str) -> str:
    return f"coalesce(list_filter({arr}, lambda s: contains(s, {q(needle)}))[1], '')"


FIPS = """
fips_lookup AS (
  SELECT c_custkey * 2 AS seq, lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS code, c_name AS label
  FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'
  UNION ALL
  SELECT c_custkey * 2 + 1, lpad(CAST(c_custkey AS VARCHAR), 5, '0'), lower(c_name)
  FROM customer WHERE c_mktsegment = 'MACHINERY'),
fips_one AS (SELECT code, arg_max(label, seq) AS label FROM fips_lookup GROUP BY code)"""

EXISTING_STATES = """
existing AS (SELECT row_number() OVER (ORDER BY c_name) AS id, c_name AS country_name, n_name AS name
             FROM cust WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE'))"""

FLAT80 = f"""
flat80 AS (
  SELECT n_name AS state, c_name AS country_name, l_partkey AS disaster_number, p_type AS incident_type,
         CAST(o_orderdate AS DATE) AS incident_begin_date, CAST(l_shipdate AS DATE) AS incident_end_date,
         {LINE_DURATION} AS incident_duration,
         p_size % 2 = 1 AS ih_program_declared, p_size > 25 AS ia_program_declared,
         p_retailprice > 1500 AS pa_program_declared, p_brand = 'Brand#1' AS hm_program_declared,
         CAST(l_quantity AS INTEGER) AS deaths, o_orderpriority AS declaration_title, o_orderstatus AS declaration_type,
         CAST(o_orderdate AS DATE) AS declaration_date, l_orderkey AS declaration_request_number
  FROM lines JOIN cust ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey WHERE NOT is_test),
states AS (
  SELECT row_number() OVER (ORDER BY country_name) AS id, name, country_name FROM (SELECT * FROM (
    SELECT DISTINCT state AS name, country_name FROM flat80)
  QUALIFY row_number() OVER (PARTITION BY country_name ORDER BY name ASC NULLS LAST) = 1)),
disasters AS (
  SELECT row_number() OVER (ORDER BY disaster_number) AS id, * FROM (SELECT * FROM (
    SELECT DISTINCT disaster_number, incident_type, incident_begin_date, incident_end_date, incident_duration,
           ih_program_declared, ia_program_declared, pa_program_declared, hm_program_declared, deaths FROM flat80)
  QUALIFY row_number() OVER (PARTITION BY disaster_number ORDER BY incident_type ASC NULLS LAST,
      incident_begin_date ASC NULLS LAST, incident_end_date ASC NULLS LAST, incident_duration ASC NULLS LAST,
      ih_program_declared ASC NULLS LAST, ia_program_declared ASC NULLS LAST, pa_program_declared ASC NULLS LAST,
      hm_program_declared ASC NULLS LAST, deaths ASC NULLS LAST) = 1))"""

RAW = f"""
raw AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id,
         CAST(l_partkey AS VARCHAR) AS disaster_number, CAST(l_orderkey AS VARCHAR) AS declaration_request_number,
         n_name AS state,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' AND o_orderstatus = 'P' THEN NULL
              ELSE lpad(CAST(c_custkey AS VARCHAR), 5, '0') END AS fips,
         p_type AS incident_type, nullif(o_orderpriority, '4-NOT SPECIFIED') AS declaration_title,
         o_orderstatus AS declaration_type,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '{ISO}') END AS declaration_date,
         strftime(o_orderdate, '{ISO}') AS incident_begin_date,
         CASE WHEN l_returnflag = 'R' THEN NULL ELSE strftime(l_shipdate, '{ISO}') END AS incident_end_date,
         CAST(p_size % 2 AS VARCHAR) AS ih_program_declared,
         CAST(CAST(p_size > 25 AS INTEGER) AS VARCHAR) AS ia_program_declared
  FROM lines JOIN cust ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey),
filled AS (
  SELECT id, disaster_number, declaration_request_number, state, coalesce(fips, 'unknown') AS fips, incident_type,
         coalesce(declaration_title, 'unknown') AS declaration_title, declaration_type,
         coalesce(declaration_date, 'unknown') AS declaration_date,
         strptime(incident_begin_date, '{ISO}') AS b, strptime(incident_end_date, '{ISO}') AS e,
         ih_program_declared, ia_program_declared
  FROM raw WHERE incident_end_date IS NOT NULL),
cleaned AS (
  SELECT id, disaster_number, declaration_request_number,
         CASE state WHEN 'NATION_0' THEN 'Nation zero' WHEN 'NATION_1' THEN 'Nation one'
                    WHEN 'NATION_2' THEN 'Nation two' ELSE state END AS state,
         coalesce(fo.label, f.fips) AS country_name, incident_type, declaration_title,
         CASE declaration_type WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE declaration_type END AS declaration_type,
         strftime(try_strptime(declaration_date, '{ISO}'), '%Y-%m-%d') AS declaration_date,
         strftime(b, '%Y-%m-%d') AS incident_begin_date, strftime(e, '%Y-%m-%d') AS incident_end_date,
         ih_program_declared, ia_program_declared,
         CAST({h(1, 'deaths', ['id'])} % 10000 AS INTEGER) AS deaths,
         CAST(CASE WHEN {elapsed_days('b', 'e')} = 0 THEN 1 + {h(1, 'incident_duration', ['id'])} % 24
                   ELSE {elapsed_days('b', 'e')} * 24 END AS INTEGER) AS incident_duration
  FROM filled f LEFT JOIN fips_one fo ON f.fips = fo.code)"""

PART_MERGE = """
cur AS (SELECT row_number() OVER (ORDER BY p_partkey) AS part_tk, 1 AS version, TIMESTAMP '2023-01-01 00:00:00' AS date_from,
               CAST(NULL AS TIMESTAMP) AS date_to, p_partkey AS part_number, p_size, p_brand FROM part),
inc AS (SELECT p_partkey AS part_number, CASE WHEN p_type = 'PROMO' THEN p_size + 1 ELSE p_size END AS p_size, p_brand FROM part
        UNION ALL SELECT p_partkey + 1000000000, p_size, p_brand FROM part WHERE p_size > 48),
j AS (SELECT c.*, i.part_number AS in_number, i.p_size AS in_size, i.p_brand AS in_brand,
             NOT (c.p_size IS NOT DISTINCT FROM i.p_size AND c.p_brand IS NOT DISTINCT FROM i.p_brand) AS diff
      FROM cur c FULL OUTER JOIN inc i ON c.part_number = i.part_number),
merged AS (
  SELECT part_tk, version, date_from,
         CASE WHEN in_number IS NOT NULL AND diff THEN TIMESTAMP '2024-01-01 00:00:00' ELSE date_to END AS date_to,
         part_number, p_size, p_brand FROM j WHERE part_tk IS NOT NULL
  UNION ALL
  SELECT (SELECT max(part_tk) FROM cur) + row_number() OVER (ORDER BY in_number) AS part_tk,
         CAST(coalesce(version + 1, 1) AS INTEGER) AS version, TIMESTAMP '2024-01-01 00:00:00' AS date_from,
         CAST(NULL AS TIMESTAMP) AS date_to, in_number AS part_number, in_size AS p_size, in_brand AS p_brand
  FROM j WHERE in_number IS NOT NULL AND (part_tk IS NULL OR diff))"""

# The chain on loaded entity tables: no State for household customers, no Disaster over size 45.
ENTITIES = FLAT80 + """,
e_states AS (SELECT row_number() OVER (ORDER BY country_name) AS id, name, country_name FROM states
             WHERE country_name IN (SELECT c_name FROM customer WHERE c_mktsegment <> 'HOUSEHOLD')),
e_disasters AS (SELECT row_number() OVER (ORDER BY disaster_number) AS id, * EXCLUDE (id) FROM disasters
                WHERE disaster_number IN (SELECT p_partkey FROM part WHERE p_size <= 45)),
e_declarations AS (
  SELECT row_number() OVER (ORDER BY declaration_request_number NULLS FIRST, disaster_fk NULLS FIRST, state_fk NULLS FIRST,
                            declaration_title NULLS FIRST, declaration_type NULLS FIRST, declaration_date NULLS FIRST) AS id, *
  FROM (SELECT x.declaration_title, x.declaration_type, x.declaration_date, x.declaration_request_number,
               d.id AS disaster_fk, s.id AS state_fk
        FROM (SELECT DISTINCT declaration_title, declaration_type, declaration_date, declaration_request_number,
                     country_name, disaster_number FROM flat80) x
        LEFT JOIN e_disasters d ON x.disaster_number = d.disaster_number
        LEFT JOIN e_states s ON x.country_name = s.country_name)),
e_joined AS (
  SELECT c.*, s.name AS state, s.country_name, d.* EXCLUDE (id)
  FROM e_declarations c LEFT JOIN e_states s ON c.state_fk = s.id LEFT JOIN e_disasters d ON c.disaster_fk = d.id)"""


def entity_fact() -> list[str]:
    """CTEs of the fact on the entity tables: the sources' first halves come from those tables."""

    def dim(name, src, keys, attrs, own, tk, cols, unknown, cond="TRUE"):
        one = first_per_key(f"e_{src}", keys, attrs)
        return (f"e_{src} AS (SELECT {own[0]}, 0 AS src FROM {own[1]} UNION ALL BY NAME SELECT * FROM {src} WHERE src = 1), "
                f"e_{name}_one AS (SELECT * FROM ({one}) WHERE {cond}), " + dimension(f"e_{name}", f"e_{name}_one", tk, keys, cols, unknown))

    parts = [DECL_SRC, DIS_SRC, DATES_SRC, STATE_SRC, ENTITIES]
    parts.append(dim("declaration", "decl_src", ["declaration_request_number"], ["declaration_title", "declaration_type", "declaration_date"],
                     ("declaration_request_number, declaration_title, declaration_type, declaration_date", "e_declarations"), "declaration_tk",
                     ["declaration_title", "declaration_type", "declaration_date", "declaration_request_number"],
                     {"declaration_title": "CAST(NULL AS VARCHAR)", "declaration_type": "CAST(NULL AS VARCHAR)",
                      "declaration_date": "CAST(NULL AS DATE)", "declaration_request_number": "CAST(NULL AS BIGINT)"}))
    parts.append(dim("disaster", "dis_src", ["disaster_number"], ["incident_type", *BOOLS],
                     ("disaster_number, incident_type, " + ", ".join(BOOLS), "e_disasters"), "disaster_tk", ["disaster_number", "incident_type", *BOOLS],
                     {"disaster_number": "CAST(NULL AS BIGINT)", "incident_type": "CAST(NULL AS VARCHAR)", **{b: "false" for b in BOOLS}}))
    parts.append(dim("dates", "dates_src", ["incident_begin_date", "incident_end_date"], ["incident_duration"],
                     ("incident_begin_date, incident_end_date, incident_duration", "e_disasters"), "incident_dates_tk",
                     ["incident_begin_date", "incident_end_date", "incident_duration"],
                     {"incident_begin_date": "CAST(NULL AS DATE)", "incident_end_date": "CAST(NULL AS DATE)", "incident_duration": "0"}))
    parts.append(dim("state", "state_src", ["country_name"], ["state_name"],
                     ("upper(trim(name)) AS state_name, upper(trim(country_name)) AS country_name", "e_states"), "state_tk", ["state_name", "country_name"],
                     {"state_name": "'UNKNOWN'", "country_name": "'UNKNOWN'"}, "country_name IS DISTINCT FROM 'UNKNOWN'"))
    parts.append(f"""
e_staging AS (
  SELECT country_name, disaster_number, declaration_request_number, incident_begin_date, incident_end_date, deaths,
         incident_duration AS incident_hours FROM e_joined
  UNION ALL
  SELECT trim({MESSY_COUNTY}), l_partkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE l_orderkey END,
         CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE), CAST(l_quantity AS INTEGER), {LINE_DURATION}
  FROM lines JOIN cust ON o_custkey = c_custkey WHERE is_test),
e_resolved AS (
  SELECT coalesce(s.state_tk, 0) AS state_tk, coalesce(di.disaster_tk, 0) AS disaster_tk,
         coalesce(dc.declaration_tk, 0) AS declaration_tk, coalesce(dt.incident_dates_tk, 0) AS incident_dates_tk, f.deaths, f.incident_hours
  FROM e_staging f
  LEFT JOIN e_state s ON upper(trim(f.country_name)) = upper(trim(s.country_name))
  LEFT JOIN e_disaster di ON f.disaster_number = di.disaster_number
  LEFT JOIN e_declaration dc ON f.declaration_request_number = dc.declaration_request_number
  LEFT JOIN e_dates dt ON f.incident_begin_date = dt.incident_begin_date AND f.incident_end_date = dt.incident_end_date)""")
    return parts


TK4 = ["state_tk", "disaster_tk", "declaration_tk", "incident_dates_tk"]
FACT_ALL = [ALL_DIMS, STAGING, RESOLVED, FACT]
DTYPE_COLS = "declaration_request_number, declaration_title, declaration_type, declaration_date"
STAGING_COLS = ["country_name", "state", "disaster_number", "declaration_request_number",
                "incident_begin_date", "incident_end_date", "deaths"]
LK = ", ".join(LINE_KEY)


def _cards_sql(pages: str = "pages", before: str = "") -> str:
    texts = text_nodes_sql("card")
    return f"""
WITH {before}c AS (
  SELECT page_id, unnest(arr) AS card, CAST(generate_subscripts(arr, 1) - 1 AS INTEGER) AS card_pos
  FROM (SELECT page_id, regexp_extract_all(html, {q(CARD)}, 1) AS arr FROM {pages})),
a AS (SELECT *, regexp_extract(card, {q(ANCHOR)}, 1) AS href, regexp_extract(card, {q(ANCHOR)}, 2) AS atext,
             {texts} AS texts
      FROM c WHERE regexp_matches(card, {q(ANCHOR)}))
SELECT page_id, card_pos,
       {strip_sql(unescape_sql("regexp_replace(atext, '<[^>]*>', '', 'g')"))} AS "Title",
       'https://listing.example' || {unescape_sql("regexp_replace(href, " + q(QUOTES) + ", '', 'g')")} AS "Link",
       {strip_sql(first_match_sql('texts', 'Incident Period:'))} AS "Incident Period",
       {strip_sql(first_match_sql('texts', 'Major Disaster Declaration declared'))} AS "Declaration Date"
FROM a"""


LISTING = """made AS (
  SELECT CAST(floor(o_orderkey / 20) AS BIGINT) AS page_id, '<ul>' || string_agg(
    '<li><h3><a class=x href=' || CASE o_orderkey % 3 WHEN 0 THEN '"' || h || '"' WHEN 1 THEN chr(39) || h || chr(39) ELSE h END
    || '>R&eacute;gion&#8217;s &#x201C;' || o_orderpriority || '&rdquo; <b>' || o_orderkey
    || '</b></a></h3><span>Incident&nbsp;Period</span><p> Incident Period: ' || day || ' &ndash; ' || day || '</p><p>'
    || CASE o_orderstatus WHEN 'P' THEN 'Emergency Declaration' ELSE 'Major Disaster Declaration' END
    || ' declared on ' || day || '</p></li>', chr(10) ORDER BY o_orderkey) || '</ul>' AS html
  FROM (SELECT *, '/orders/' || o_orderkey || '?a=1&amp;b=2' AS h, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders)
  GROUP BY 1),
"""


def _first_text_sql() -> str:
    return f"""
SELECT page_id, CAST(len(texts) AS INTEGER) AS n_strings, {first_match_sql('texts', '©')} AS footer_text,
       {first_match_sql('texts', '. ')} AS first_sentences
FROM (SELECT page_id, {text_nodes_sql('html')} AS texts FROM pages)"""


def _unknown_counts_sql() -> str:
    parts = [f"SELECT '{t}' AS key_column, count_if({t} = 0) AS unknown_rows, count(*) AS fact_rows FROM fact" for t in TK4]
    return with_ctes(*FACT_ALL, select="\nUNION ALL\n".join(parts))


def _not_null_sql() -> str:
    parts = [f"SELECT '{c}' AS column_name, count_if({c} IS NULL) AS null_count FROM staging" for c in STAGING_COLS]
    return with_ctes(STAGING, select="\nUNION ALL\n".join(parts))


# The type-2 part dimension after three loads; a version ends when the next one begins.
PART_VERSIONS = """
snap AS (SELECT p_partkey AS k, p_brand, p_size AS s1, p_size + CASE WHEN p_type = 'PROMO' THEN 1 ELSE 0 END AS s2,
                p_size + CASE WHEN p_type = 'PROMO' THEN 1 ELSE 0 END + CASE WHEN p_brand = 'Brand#1' THEN 2 ELSE 0 END AS s3 FROM part),
v1 AS (SELECT row_number() OVER (ORDER BY k) AS tk, k, s1 AS size FROM snap WHERE s1 <= 45),
v2 AS (SELECT (SELECT max(tk) FROM v1) + row_number() OVER (ORDER BY k) AS tk, k, s2 AS size FROM snap
       WHERE s1 > 45 OR s2 <> s1),
v3 AS (SELECT (SELECT max(tk) FROM v2) + row_number() OVER (ORDER BY k) AS tk, k, s3 AS size FROM snap WHERE s3 <> s2),
part_versions AS (
  SELECT tk AS part_tk, k AS part_number, size, TIMESTAMP '1996-01-01' AS date_from FROM v1
  UNION ALL SELECT tk, k, size, TIMESTAMP '1998-01-01' FROM v2
  UNION ALL SELECT tk, k, size, TIMESTAMP '2000-01-01' FROM v3)
"""


ORACLE: dict[str, str] = {
    "fact_build": with_ctes(*FACT_ALL, select="SELECT * FROM fact"),
    "staging_fact": with_ctes(STAGING, select="SELECT * FROM staging"),
    "denormalize_fk": with_ctes(STAGING_DB, select="SELECT * FROM staging_db"),
    "join_normalized_key": with_ctes(
        STATE_DIM, STAGING,
        select="SELECT coalesce(s.state_tk, 0) AS state_tk, f.country_name FROM staging f "
               "LEFT JOIN state_dim s ON upper(trim(f.country_name)) = upper(trim(s.country_name))"),
    "fact_key_lookup": with_ctes(
        DIS_DIM, STAGING,
        select="SELECT coalesce(d.disaster_tk, 0) AS disaster_tk, f.declaration_request_number, f.disaster_number "
               "FROM staging f LEFT JOIN disaster_dim d ON f.disaster_number = d.disaster_number"),
    "join_composite_key": with_ctes(
        DATES_DIM, STAGING,
        select="SELECT coalesce(d.incident_dates_tk, 0) AS incident_dates_tk, f.incident_begin_date, f.incident_end_date "
               "FROM staging f LEFT JOIN dates_dim d ON f.incident_begin_date = d.incident_begin_date "
               "AND f.incident_end_date = d.incident_end_date"),
    "fact_unknown_member": _unknown_counts_sql(),
    "dim_declaration": with_ctes(DECL_DIM, select="SELECT * FROM declaration_dim"),
    "dim_disaster": with_ctes(DIS_DIM, select="SELECT * FROM disaster_dim"),
    "dim_incident_dates": with_ctes(DATES_DIM, select="SELECT * FROM dates_dim"),
    "dim_state": with_ctes(STATE_DIM, select="SELECT * FROM state_dim"),
    "dim_generic": with_ctes(
        dimension("supplier_dim", "supplier", "supplier_tk", ["s_suppkey"], ["s_suppkey", "s_name", "s_nationkey"],
                  {"s_suppkey": "CAST(NULL AS BIGINT)", "s_name": "'UNKNOWN'", "s_nationkey": "CAST(NULL AS INTEGER)"}),
        select="SELECT * FROM supplier_dim"),
    "dim_stable_keys": with_ctes(
        DECL_DIM,
        select="SELECT row_number() OVER (ORDER BY declaration_tk > 0, old IS NULL, declaration_request_number) - 1 AS declaration_tk, * EXCLUDE (declaration_tk, old) "
               "FROM declaration_dim LEFT JOIN (SELECT DISTINCT declaration_request_number AS old FROM decl_src WHERE src = 0) ON declaration_request_number = old"),
    "union_sources": with_ctes(DECL_SRC, select=f"SELECT {DTYPE_COLS}, src AS source_rank FROM decl_src"),
    "dedup_natural_key": with_ctes(
        DECL_SRC, select=first_per_key("decl_src", ["declaration_request_number"],
                                       ["declaration_title", "declaration_type", "declaration_date"])),
    "dedup_composite_key": with_ctes(
        DATES_SRC, select=first_per_key("dates_src", ["incident_begin_date", "incident_end_date"], ["incident_duration"])),
    "surrogate_key": "SELECT p_name, row_number() OVER (ORDER BY p_name) AS name_tk FROM (SELECT DISTINCT p_name FROM part)",
    "surrogate_key_multi": "SELECT p_brand, p_type, p_size, row_number() OVER (ORDER BY p_brand, p_type, p_size) AS combo_tk "
                           "FROM (SELECT DISTINCT p_brand, p_type, p_size FROM part)",
    "scd1_columns": f"SELECT p_partkey, p_name, 1 AS version, {LOAD_TS} AS date_from, CAST(NULL AS TIMESTAMP) AS date_to FROM part",
    "unknown_member": "SELECT CAST(0 AS BIGINT) AS priority_tk, 'UNKNOWN' AS o_orderpriority UNION ALL "
                      "SELECT row_number() OVER (ORDER BY o_orderpriority), o_orderpriority FROM (SELECT DISTINCT o_orderpriority FROM orders)",
    "csv_roundtrip": "SELECT lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS code, c_name, c_acctbal, c_mktsegment FROM customer",
    "csv_infer": "SELECT CAST(c_custkey AS INTEGER) AS code, c_name, c_acctbal FROM customer",
    "jdbc_roundtrip": "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer",
    "append_load": with_ctes(
        EXISTING_STATES,
        select="SELECT * FROM existing UNION ALL "
               "SELECT (SELECT max(id) FROM existing) + row_number() OVER (ORDER BY c_name) AS id, c_name AS country_name, n_name AS name "
               "FROM cust WHERE c_name NOT IN (SELECT country_name FROM existing)"),
    "drop_columns": "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders",
    "project_cols": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
    "rename_alias": "SELECT o_orderkey AS declaration_request_number, o_orderpriority AS declaration_title, "
                    "o_orderstatus AS declaration_type FROM orders",
    "cast_types": "SELECT o_orderkey, cust_text, TRY_CAST(cust_text AS INTEGER) AS cust_int FROM ("
                  "SELECT o_orderkey, coalesce(CAST(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS VARCHAR), 'unknown') AS cust_text FROM orders)",
    "cast_bool_cols": with_ctes(DIS_SRC, select="SELECT disaster_number, " + ", ".join(BOOLS) + " FROM dis_src WHERE src = 1"),
    "fill_unknown": "SELECT o_orderkey, coalesce(nullif(o_orderpriority, '4-NOT SPECIFIED'), 'unknown') AS o_orderpriority, "
                    "coalesce(CAST(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS VARCHAR), 'unknown') AS o_custkey, "
                    "coalesce(CAST(CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS VARCHAR), 'unknown') AS o_orderdate "
                    "FROM orders",
    "drop_null_keys": with_ctes(DECL_SRC, select=f"SELECT {DTYPE_COLS} FROM decl_src WHERE src = 1 AND declaration_request_number IS NOT NULL"),
    "distinct_rows": "SELECT DISTINCT o_custkey, o_orderstatus FROM orders",
    "head_n": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
    "row_counts": "SELECT 'orders' AS table_name, count(*) AS n_rows, CAST(6 AS BIGINT) AS n_columns FROM orders UNION ALL "
                  "SELECT 'customer', count(*), CAST(5 AS BIGINT) FROM customer UNION ALL "
                  "SELECT 'lineitem', count(*), CAST(11 AS BIGINT) FROM lineitem",
    "normalize_text": "SELECT c_custkey, raw_name, upper(trim(raw_name)) AS name_key, "
                      + strip_sql("raw_segment") + " AS segment FROM (SELECT c_custkey, '  ' || lower(c_name) || ' ' AS raw_name, "
                      "chr(9) || c_mktsegment || ' ' || chr(10) AS raw_segment FROM customer)",
    "parse_dates": f"SELECT o_orderkey, iso_text, CAST(try_strptime(iso_text, '{ISO}') AS DATE) AS order_day, "
                   f"strftime(try_strptime(iso_text, '{ISO}'), '%Y-%m-%d') AS day_text FROM ("
                   f"SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'unknown' ELSE strftime(o_orderdate, '{ISO}') END AS iso_text FROM orders)",
    "derive_duration": with_ctes(
        select=f"SELECT {LK}, {elapsed_days('o_orderdate', 'l_shipdate')} AS elapsed_days, {LINE_DURATION} AS incident_duration FROM lines"),
    "duration_fallback": f"SELECT {LK}, CAST(o_orderdate AS DATE) AS incident_begin_date, CAST(l_shipdate AS DATE) AS incident_end_date, "
                         f"CAST(coalesce(CASE WHEN l_returnflag = 'N' THEN NULL ELSE 1 + {h(1, 'hours', LINE_KEY)} % 240 END, "
                         f"date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) * 24) AS INTEGER) AS incident_duration "
                         f"FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "duration_precise": with_ctes(select=f"SELECT {LK}, date_diff('second', o_orderdate, l_shipdate) AS duration_seconds FROM lines"),
    "synthetic_measure": f"SELECT o_orderkey, CAST({h(1, 'deaths', ['o_orderkey'])} % 10000 AS INTEGER) AS deaths FROM orders",
    "split_train": with_ctes(select="SELECT o_orderkey, o_custkey, o_orderstatus FROM osplit WHERE NOT is_test"),
    "split_test": with_ctes(select="SELECT o_orderkey, o_custkey, o_orderstatus FROM osplit WHERE is_test"),
    "recode_small": "SELECT event_id, CASE event_type WHEN 'click' THEN 'Click' WHEN 'view' THEN 'Page view' "
                    "WHEN 'purchase' THEN 'Purchase' ELSE event_type END AS event_type FROM events",
    "recode_lookup": "WITH" + FIPS + "\nSELECT o_orderkey, fips, coalesce(fo.label, fips) AS country_name FROM ("
                     "SELECT o_orderkey, lpad(CAST(o_custkey AS VARCHAR), 5, '0') AS fips FROM orders) o LEFT JOIN fips_one fo ON o.fips = fo.code",
    "normalize_entities": with_ctes(FLAT80, select="SELECT * FROM disasters"),
    "normalize_states": with_ctes(FLAT80, select="SELECT * FROM states"),
    "normalize_declarations": with_ctes(
        FLAT80,
        select="""SELECT row_number() OVER (ORDER BY declaration_request_number, disaster_fk, state_fk, declaration_title,
                                             declaration_type, declaration_date) AS id,
                  declaration_title, declaration_type, declaration_date, declaration_request_number, disaster_fk, state_fk
           FROM (SELECT x.*, (SELECT min(id) FROM disasters d WHERE d.disaster_number = x.disaster_number) AS disaster_fk,
                        (SELECT min(id) FROM states s WHERE s.country_name = x.country_name) AS state_fk
                 FROM (SELECT DISTINCT declaration_title, declaration_type, declaration_date, declaration_request_number,
                              country_name, disaster_number FROM flat80) x)
           WHERE disaster_fk IS NOT NULL"""),
    "first_match_lookup": with_ctes(
        FLAT80,
        select="SELECT x.declaration_request_number, x.incident_type, m.disaster_fk FROM "
               "(SELECT DISTINCT declaration_request_number, incident_type FROM flat80) x "
               "LEFT JOIN (SELECT incident_type, min(id) AS disaster_fk FROM disasters GROUP BY incident_type) m "
               "ON x.incident_type = m.incident_type"),
    "insert_if_absent": with_ctes(
        EXISTING_STATES, FLAT80,
        select="SELECT (SELECT max(id) FROM existing) + row_number() OVER (ORDER BY country_name) AS id, name, country_name FROM ("
               "SELECT * FROM (SELECT DISTINCT state AS name, country_name FROM flat80 WHERE country_name NOT IN (SELECT country_name FROM existing)) "
               "QUALIFY row_number() OVER (PARTITION BY country_name ORDER BY name ASC NULLS LAST) = 1)"),
    "bridge_table": with_ctes(
        FLAT80,
        select="SELECT row_number() OVER (ORDER BY disaster_fk, state_fk) AS id, disaster_fk, state_fk FROM ("
               "SELECT DISTINCT d.disaster_fk, s.state_fk FROM (SELECT DISTINCT disaster_number, country_name FROM flat80) p "
               "JOIN (SELECT disaster_number, min(id) AS disaster_fk FROM disasters GROUP BY ALL) d ON p.disaster_number = d.disaster_number "
               "JOIN (SELECT country_name, min(id) AS state_fk FROM states GROUP BY ALL) s ON p.country_name = s.country_name)"),
    "denormalize_unmatched": with_ctes(ENTITIES, select="SELECT * FROM e_joined"),
    "fact_from_entities": with_ctes(
        *entity_fact(),
        select="SELECT *, row_number() OVER (ORDER BY state_tk, disaster_tk, declaration_tk, incident_dates_tk, "
               "deaths NULLS FIRST, incident_hours NULLS FIRST) AS disaster_fact_tk FROM e_resolved"),
    "check_not_null": _not_null_sql(),
    "check_unique": "SELECT l_orderkey, l_linenumber, count(*) AS dup_count FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "check_fk": f"SELECT {LK} FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 45)",
    "html_cards": _cards_sql(),
    "listing_cards": _cards_sql("made", LISTING),
    "html_cards_nested": _cards_sql("made", LISTING),
    "first_match_text": _first_text_sql(),
    "pages_until_empty": f"""
WITH c AS (SELECT page_id, CAST(len(regexp_extract_all(html, {q(CARD)}, 1)) AS INTEGER) AS n_cards FROM pages)
SELECT * FROM c WHERE (SELECT min(page_id) FROM c WHERE n_cards < 6) IS NULL
                   OR page_id < (SELECT min(page_id) FROM c WHERE n_cards < 6)""",
    "clean_and_split": with_ctes(
        FIPS.lstrip(), RAW,
        select="SELECT * EXCLUDE (id, _h), row_number() OVER (ORDER BY _h, id) <= round_even(count(*) OVER () * 0.2, 0) AS is_test "
               f"FROM (SELECT *, {h60(1, ['id'])} AS _h FROM cleaned)"),
    "clean_csv_files": with_ctes(
        FIPS.lstrip(), RAW,
        select="SELECT * EXCLUDE (id, _h), row_number() OVER (ORDER BY _h, id) <= round_even(count(*) OVER () * 0.2, 0) AS is_test "
               f"FROM (SELECT *, {h60(1, ['id'])} AS _h FROM cleaned)"),
    "scd2_merge": "WITH " + PART_MERGE + "\nSELECT * FROM merged",
    "scd2_merge_touched": "WITH " + PART_MERGE + "\nSELECT * FROM merged",
    "scd2_history": "WITH " + PART_MERGE + """
SELECT part_number, version, previous_value, new_value FROM (
  SELECT part_number, version, lag(p_size) OVER (PARTITION BY part_number ORDER BY version) AS previous_value, p_size AS new_value
  FROM merged) WHERE version > 1 AND previous_value IS DISTINCT FROM new_value""",
    "fact_rollup": with_ctes(
        *FACT_ALL,
        select="""SELECT state_name, incident_year, incident_type, CAST(sum(deaths) AS BIGINT) AS deaths,
                  CAST(count(*) AS BIGINT) AS fact_rows,
                  CAST(grouping(state_name, incident_year, incident_type) AS BIGINT) AS grouping_level
           FROM (SELECT s.state_name, CAST(year(dt.incident_begin_date) AS INTEGER) AS incident_year,
                        upper(di.incident_type) AS incident_type, f.deaths
                 FROM fact f LEFT JOIN state_dim s ON f.state_tk = s.state_tk
                 LEFT JOIN dates_dim dt ON f.incident_dates_tk = dt.incident_dates_tk
                 LEFT JOIN disaster_dim di ON f.disaster_tk = di.disaster_tk)
           GROUP BY ROLLUP (state_name, incident_year, incident_type)"""),
    "fact_by_month": """
SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, CAST(quarter(l_shipdate) AS INTEGER) AS ship_quarter, count(*) AS n_lines,
       CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem WHERE year(l_shipdate) = 1998 GROUP BY ALL""",
    "fact_colocated": with_ctes(
        DECL_DIM,
        select="""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, request AS declaration_request_number, coalesce(declaration_tk, 0) AS declaration_tk
          FROM (SELECT *, CASE WHEN is_test AND o_orderstatus = 'P' THEN NULL ELSE l_orderkey END AS request FROM lines)
          LEFT JOIN declaration_dim ON request = declaration_request_number"""),
    "quarantine": with_ctes(
        """judged AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
             CASE WHEN is_test AND o_orderstatus = 'P' THEN NULL ELSE l_orderkey END AS declaration_request_number,
             l_partkey AS disaster_number, CAST(l_shipdate AS DATE) AS incident_end_date,
             row_number() OVER (PARTITION BY l_partkey, CAST(l_shipdate AS DATE) ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS nth
           FROM lines)""",
        select="""SELECT * EXCLUDE (nth), concat_ws(';', CASE WHEN declaration_request_number IS NULL THEN 'null:declaration_request_number' END,
             CASE WHEN nth > 1 THEN 'duplicate:disaster_number,incident_end_date' END,
             CASE WHEN disaster_number NOT IN (SELECT p_partkey FROM part WHERE p_size <= 45) THEN 'orphan:disaster_number' END) AS reasons
           FROM judged"""),
    "fact_as_of": "WITH " + PART_VERSIONS + """
SELECT coalesce(v.part_tk, 0) AS part_tk, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_shipdate
FROM lineitem l ASOF LEFT JOIN part_versions v ON l.l_partkey = v.part_number AND l.l_shipdate >= v.date_from""",
}
ORACLE["fact_rollup_delta"] = ORACLE["fact_rollup"]

"""DuckDB SQL of the carrier queries, written from the rules and not from the Spark plans."""

from __future__ import annotations

INTERVALS = """
  SELECT o_orderkey AS code, CAST(o_orderdate AS DATE) AS s, e FROM orders
  JOIN (SELECT l_orderkey, CAST(max(l_shipdate) AS DATE) AS e FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey"""
DATES = "(VALUES ('1921', DATE '1996-12-01'), ('1927', DATE '1997-10-15'), ('1929', DATE '1998-10-15'), ('ref', DATE '1999-06-15')) d(label, day)"
ALIVE = f"SELECT label, CAST(count(DISTINCT code) AS BIGINT) AS n_alive FROM ({INTERVALS}) i JOIN {DATES} ON s <= day AND e >= day GROUP BY label"

CODES = "SELECT CASE WHEN length(CAST(p_partkey AS VARCHAR)) < 6 THEN lpad(CAST(p_partkey AS VARCHAR), 6, '0') ELSE CAST(p_partkey AS VARCHAR) END AS code, p_partkey AS k, p_name, p_type FROM part"


def _bridge(size: int, ref: int) -> str:
    return f"""
  SELECT code, arg_min(dest, first_k) AS dest FROM (
    SELECT c.code, g.dest, g.first_k FROM (SELECT *, p_name || '/' || (k // {size}) AS key FROM ({CODES})) c
    JOIN (SELECT p_name || '/' || (k // {size}) AS key, count(*) FILTER (WHERE k % {ref} = 0) AS n, max(code) FILTER (WHERE k % {ref} = 0) AS dest, min(k) AS first_k
          FROM ({CODES}) GROUP BY 1) g USING (key) WHERE g.n = 1 AND c.k % {ref} <> 0) GROUP BY code"""


def _closure(filter_: str) -> str:
    return f"""
  edges AS (
    SELECT k AS src, k // 2 AS dst FROM ({CODES}) WHERE {filter_} UNION SELECT k, 2 * k // 3 FROM ({CODES}) WHERE {filter_}),
  steps AS (SELECT * FROM edges WHERE dst <> 0 AND src % 97 <> 0),
  walk(src, pos, n) AS (
    SELECT src, dst, 1 FROM steps
    UNION SELECT w.src, s.dst, w.n + 1 FROM walk w JOIN steps s ON s.src = w.pos WHERE w.pos % 97 <> 0 AND w.n < 10),
  reach AS (SELECT DISTINCT lpad(CAST(src AS VARCHAR), 6, '0') AS code, lpad(CAST(pos AS VARCHAR), 6, '0') AS dest FROM walk WHERE pos % 97 = 0)"""


PLAIN = "trim(regexp_replace(strip_accents(upper(replace({0}, 'ß', 'ss'))), '\\s+', ' ', 'g'))"

FORWARD = f"""
  codes AS ({CODES}),
  bridge AS ({_bridge(200, 97)}),
  {_closure("k % 5 <> 0")},
  many AS (SELECT code, list_sort(list(dest)) AS dests FROM reach GROUP BY code),
  registry AS (SELECT *, p_name || '/' || (k // 200) AS key FROM codes WHERE k % 5 = 0),
  in_ref AS (SELECT code FROM codes WHERE k % 97 = 0),
  key_hits AS (
    SELECT key, min(hit) AS hit FROM (
      SELECT r.key, r.code AS hit FROM registry r JOIN in_ref USING (code) UNION ALL SELECT r.key, b.dest FROM registry r JOIN bridge b USING (code)) GROUP BY key),
  name_hits AS (SELECT substr(code, 1, 3) AS prov, upper(trim(p_type)) AS nm, min(code) AS hit FROM registry JOIN in_ref USING (code) GROUP BY 1, 2),
  rescue AS (
    SELECT r.code, coalesce(a.hit, n.hit) AS dest FROM registry r LEFT JOIN key_hits a USING (key)
    LEFT JOIN name_hits n ON n.prov = substr(r.code, 1, 3) AND n.nm = upper(trim(r.p_type))),
  alive AS (
    SELECT '1921' AS label, code, k FROM codes WHERE k % 2 <> 0 UNION ALL SELECT '1927', code, k FROM codes WHERE k % 3 <> 0 UNION ALL SELECT '1929', code, k FROM codes WHERE k % 7 <> 0),
  forward AS (
    SELECT label, a.code,
      CASE WHEN k % 97 = 0 THEN 'DIRECT' WHEN b.dest IS NOT NULL THEN 'CATASTALE' WHEN m.dests IS NOT NULL THEN 'SISTAT'
        WHEN substr(a.code, 1, 3) IN ('701', '702', '703', '801', '802') THEN 'LOST_TERRITORY' WHEN r.dest IS NOT NULL THEN 'ANPR_FALLBACK' ELSE 'UNTRACED' END AS method,
      CASE WHEN k % 97 = 0 THEN [a.code] WHEN b.dest IS NOT NULL THEN [b.dest] WHEN m.dests IS NOT NULL THEN m.dests
        WHEN substr(a.code, 1, 3) IN ('701', '702', '703', '801', '802') THEN [] WHEN r.dest IS NOT NULL THEN [r.dest] ELSE [] END AS dests
    FROM alive a LEFT JOIN bridge b USING (code) LEFT JOIN many m USING (code) LEFT JOIN rescue r USING (code))"""

_LABELS = ("1921", "1927", "1929")
CLASSIFIED = (
    FORWARD
    + """,
  inverse AS (SELECT f.label, f.code AS src, f.method, d.dest FROM forward f, unnest(f.dests) d(dest) WHERE d.dest IN (SELECT code FROM in_ref)),
  children AS (SELECT DISTINCT f.label, d.dest AS code FROM forward f, unnest(f.dests) d(dest) WHERE len(f.dests) > 1),
  per AS (
    SELECT r.code, l.label, count(i.src) AS n, coalesce(string_agg(i.src, '|' ORDER BY i.src), '') AS mapping, bool_or(c.code IS NOT NULL) AS child, bool_or(a.code IS NOT NULL) AS living
    FROM in_ref r CROSS JOIN (VALUES ('1921'), ('1927'), ('1929')) l(label)
    LEFT JOIN inverse i ON i.dest = r.code AND i.label = l.label LEFT JOIN children c ON c.code = r.code AND c.label = l.label
    LEFT JOIN alive a ON a.code = r.code AND a.label = l.label GROUP BY 1, 2),
  reasons AS (
    SELECT code, string_agg(reason, '; ' ORDER BY reason) AS reason FROM (
      SELECT code, 'unmapped_' || label AS reason FROM per WHERE n = 0 AND living UNION SELECT code, 'split_child_' || label FROM per WHERE child) GROUP BY code),
  classified AS (
    SELECT p.code, """
    + ", ".join(f"max(mapping) FILTER (WHERE label = '{k}') AS mapping_{k}, CAST(max(n) FILTER (WHERE label = '{k}') AS BIGINT) AS n_constituents_{k}" for k in _LABELS)
    + """,
      CASE WHEN max(n) > 1 THEN 'AGGREGATE' ELSE 'DIRECT' END AS mapping_type,
      CASE WHEN max(r.reason) IS NULL THEN 'USABLE' ELSE 'DISCARD' END AS status, coalesce(max(r.reason), '') AS discard_reason,
      false AS territory_transfer_flag, min(n) > 0 AS traceable_all_years
    FROM per p LEFT JOIN reasons r ON r.code = p.code GROUP BY p.code)"""
)

COMPARED = """
  SELECT l_suppkey, l_orderkey, l_linenumber, x AS extracted, y AS reference,
    CASE WHEN x IS NULL THEN 'extracted_null' WHEN y IS NULL THEN 'csv_empty' WHEN x = 0 AND y = 0 THEN 'match' WHEN x = 0 OR y = 0 THEN 'mismatch'
      WHEN abs(x - y) / greatest(abs(x), abs(y)) <= 0.10 THEN 'match' ELSE 'mismatch' END AS value_status,
    coalesce(x = y, false) AS exact_equal
  FROM (SELECT *, CASE WHEN k % 11 = 0 THEN NULL WHEN k % 13 = 0 THEN 0 ELSE CAST(round(l_extendedprice) AS BIGINT) END AS x,
          CASE WHEN k % 17 = 0 THEN NULL ELSE round(l_quantity * p_retailprice * (1 + (k % 5 - 2) * CAST(0.07 AS DOUBLE))) END AS y
        FROM (SELECT *, l_orderkey + l_linenumber AS k FROM lineitem JOIN part ON l_partkey = p_partkey))"""
RATES = f"""
  SELECT l_suppkey, count(*) AS total, count(*) FILTER (WHERE value_status IN ('match', 'mismatch')) AS comparable, count(*) FILTER (WHERE value_status = 'match') AS matched,
    round(coalesce(count(*) FILTER (WHERE value_status = 'match') / nullif(count(*) FILTER (WHERE value_status IN ('match', 'mismatch')), 0), 1.0), 4) AS match_rate
  FROM ({COMPARED}) GROUP BY 1"""


def _totals(diff: str) -> str:
    return f"""
SELECT key, field, stated, computed, {diff} AS diff FROM (
  SELECT o_orderkey AS key, 'price' AS field, CAST(round(o_totalprice * 100) AS BIGINT) AS stated, CAST(p AS BIGINT) AS computed FROM orders JOIN s ON k = o_orderkey
  UNION ALL
  SELECT o_orderkey, 'quantity', CASE WHEN o_orderkey % 4 <> 0 THEN CAST(5000 AS BIGINT) END, CAST(q AS BIGINT) FROM orders JOIN s ON k = o_orderkey)
WHERE stated IS NOT NULL AND stated <> computed"""


_SUMS = """WITH s AS (SELECT l_orderkey AS k, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS p,
  coalesce(sum(CASE WHEN l_linenumber <> 3 THEN CAST(round(l_quantity * 100) AS BIGINT) END), 0) AS q FROM lineitem GROUP BY 1)"""
KEY = "regexp_replace({0}, '^[A-Za-z#]+0*', '')"

ORACLES: dict[str, str] = {
    "alive_sets": ALIVE,
    "alive_drift": f"""
SELECT x.label, CAST(x.expected AS BIGINT) AS expected, coalesce(n_alive, 0) AS actual
FROM (VALUES ('1921', 4109), ('1927', 5772), ('1929', 7000), ('ref', 7546)) x(label, expected) LEFT JOIN ({ALIVE}) a ON a.label = x.label WHERE x.expected <> coalesce(n_alive, 0)""",
    "key_bridge": _bridge(50, 30),
    "lineage_closure": f"WITH RECURSIVE {_closure('true')} SELECT code, dest FROM reach",
    "forward_cascade": f"WITH RECURSIVE {FORWARD} SELECT label, code, method, array_to_string(dests, '|') AS dest FROM forward",
    "method_counts": f"WITH RECURSIVE {FORWARD} SELECT label, method, CAST(count(*) AS BIGINT) AS n FROM forward GROUP BY 1, 2",
    "split_children": f"WITH RECURSIVE {FORWARD} SELECT DISTINCT label, d.dest AS code FROM forward, unnest(dests) d(dest) WHERE len(dests) > 1",
    "reverse_classify": f"WITH RECURSIVE {CLASSIFIED} SELECT * FROM classified",
    "reason_histogram": f"""WITH RECURSIVE {CLASSIFIED}
SELECT CASE WHEN len(string_split(r, '_')) > 2 THEN regexp_replace(r, '_[^_]*$', '') ELSE r END AS reason, CAST(count(*) AS BIGINT) AS n
FROM (SELECT unnest(string_split(discard_reason, '; ')) AS r FROM classified WHERE status = 'DISCARD') GROUP BY 1""",
    "territory_flag": """
WITH chosen AS (SELECT * FROM events WHERE event_type IN ('click', 'purchase') AND CAST(ts AS DATE) BETWEEN DATE '2024-01-02' AND DATE '2024-01-03')
SELECT DISTINCT code FROM (
  SELECT user_id AS code FROM chosen
  UNION ALL SELECT user_id + 1 FROM events WHERE event_type = 'view' AND event_id % 1000 IN (SELECT event_id % 1000 FROM chosen))
WHERE code IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)""",
    "match_cascade": f"""
WITH c AS (SELECT CAST(c_custkey AS VARCHAR) AS code, {KEY.format("c_name")} AS nm, n_name AS prov FROM customer JOIN nation ON c_nationkey = n_nationkey),
s AS (SELECT s_suppkey AS idx, {KEY.format("s_name")} AS nm, n_name AS prov FROM supplier JOIN nation ON s_nationkey = n_nationkey),
a AS (
  SELECT c.code,
    (SELECT max(idx) FROM s WHERE s.nm = c.nm AND s.prov = c.prov) AS exact_idx,
    (SELECT max(idx) FROM s WHERE s.nm = c.nm AND s.prov = CASE c.prov WHEN 'NATION_1' THEN 'NATION_2' WHEN 'FRANCE' THEN 'GERMANY' ELSE c.prov END) AS near_idx,
    (SELECT max(idx) FROM s WHERE s.nm = CASE c.code WHEN '3' THEN '7' WHEN '200' THEN '9' WHEN '201' THEN 'none' END) AS manual_idx,
    (SELECT CASE WHEN count(*) = 1 THEN max(idx) END FROM s WHERE s.nm = c.nm) AS unique_idx
  FROM c)
SELECT code, CASE WHEN exact_idx IS NOT NULL THEN 'exact' WHEN near_idx IS NOT NULL THEN 'fuzzy' WHEN manual_idx IS NOT NULL THEN 'manual' WHEN unique_idx IS NOT NULL THEN 'name_only' ELSE 'unmatched' END AS level,
  coalesce(exact_idx, near_idx, manual_idx, unique_idx) AS panel_idx FROM a""",
    "norm_n1": f"""
SELECT doc_id, {PLAIN.format("text")} AS norm, trim(regexp_replace(replace(replace({PLAIN.format("text")}, chr(39), ''), '-', ' '), '\\s+', ' ', 'g')) AS loose FROM documents""",
    "norm_n4": f"SELECT doc_id, regexp_replace({PLAIN.format('text')}, '[^\\p{{L}}\\p{{N}}_\\s'']', '', 'g') AS norm FROM documents",
    "norm_n3": """
SELECT doc_id, trim(regexp_replace(array_to_string(list_transform(string_split(upper(replace(text, 'ß', 'ss')), ''), lambda c: CASE WHEN strip_accents(c) <> c THEN strip_accents(c) || chr(39) ELSE c END), ''), '\\s+', ' ', 'g')) AS norm FROM documents""",
    "pad_code": """
SELECT c_custkey, code, substr(code, 1, 3) AS province FROM (
  SELECT c_custkey, CASE WHEN t IS NULL THEN '' WHEN length(d) < 6 THEN lpad(d, 6, '0') ELSE d END AS code FROM (
    SELECT *, CAST(CAST(trunc(TRY_CAST(t AS DOUBLE)) AS BIGINT) AS VARCHAR) AS d FROM (
      SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN c_custkey || '.0' WHEN c_custkey % 5 = 0 THEN '12345' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS t FROM customer)))""",
    "title_case": """
SELECT p_partkey, array_to_string(list_transform(regexp_extract_all(t, '\\p{L}+|[^\\p{L}]+'), lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), '') AS title FROM (
  SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN replace(p_type, ' ', chr(39)) WHEN p_partkey % 4 = 1 THEN replace(p_type, ' ', '-') ELSE p_type END AS t FROM part)""",
    "parse_number": """
SELECT o_orderkey, TRY_CAST(CASE WHEN trim(t) NOT IN ('', '..', '—') THEN regexp_replace(t, '[^0-9-]', '', 'g') END AS BIGINT) AS number, k = 5 AS spoilt,
  CAST(trunc(TRY_CAST(t || '.7' AS DOUBLE)) AS BIGINT) AS cut FROM (
  SELECT o_orderkey, o_orderkey % 8 AS k, CASE o_orderkey % 8 WHEN 0 THEN '..' WHEN 1 THEN '—' WHEN 2 THEN (v // 1000) || ' ' || lpad(CAST(v % 1000 AS VARCHAR), 3, '0')
    WHEN 3 THEN v || ' *' WHEN 4 THEN '-' || v WHEN 5 THEN '12-34' WHEN 6 THEN ' ' ELSE CAST(v AS VARCHAR) END AS t FROM (SELECT *, o_orderkey * 137 AS v FROM orders))""",
    "md_table_parse": """
WITH r AS (
  SELECT n_name AS region, s_suppkey AS page, CASE WHEN s_suppkey % 13 = 0 THEN 'COMUNI' ELSE s_name END AS nm, s_suppkey AS k FROM supplier JOIN nation ON s_nationkey = n_nationkey
  WHERE s_suppkey % 19 <> 0 AND s_suppkey % 11 <> 0 AND s_suppkey % 13 <> 0)
SELECT region, page, nm AS comune_raw, CASE WHEN k % 5 = 0 THEN k * 7 + 1 ELSE k * 7 END AS popres_1921_tot, k * 4 AS popres_1921_f,
  CASE WHEN k % 5 = 0 THEN k * 7 + 1 ELSE k * 7 END - k * 5 AS analfabeti_1921, k * 5 AS mf_literate
FROM r WHERE k % 7 <> 0 AND k % 17 <> 0""",
    "carry_forward": """
SELECT conv_id, turn, last_value(CASE WHEN turn % 3 = 0 THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried FROM conversations""",
    "sequence_check": """
SELECT conv_id, turn, number, expected FROM (
  SELECT *, coalesce(last_value(number IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS expected
  FROM (SELECT conv_id, turn, CASE WHEN turn % 3 <> 1 AND turn % 5 <> 4 THEN turn + 1 END AS number FROM conversations))
WHERE number IS NOT NULL AND number <> expected""",
    "fuzzy_length_bound": """
WITH p AS (SELECT DISTINCT upper(p_name) AS name FROM part),
w AS (SELECT DISTINCT CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE regexp_replace(upper(p_name), '[AE]', 'Y', 'g') END AS word FROM part)
SELECT word, name FROM w, p WHERE 2.0 * least(length(word), length(name)) / (length(word) + length(name)) >= 0.85""",
    "reconcile": """
SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'left_only' WHEN d.doc_id IS NULL THEN 'right_only' ELSE 'matched' END AS side
FROM (SELECT DISTINCT doc_id FROM documents) d FULL JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id""",
    "tolerance_compare": f"SELECT l_orderkey, l_linenumber, extracted, value_status, exact_equal FROM ({COMPARED})",
    "compare_tally": f"""
SELECT *, round(coalesce(100.0 * matched / nullif(matched + mismatched, 0), 0), 1) AS accuracy FROM (
  SELECT count(*) FILTER (WHERE l_suppkey % 9 <> 0 AND value_status = 'match') AS matched, count(*) FILTER (WHERE l_suppkey % 9 <> 0 AND value_status = 'mismatch') AS mismatched,
    count(*) FILTER (WHERE l_suppkey % 9 <> 0 AND value_status IN ('csv_empty', 'extracted_null')) AS csv_empty, count(*) FILTER (WHERE l_suppkey % 9 = 0) AS no_ref FROM ({COMPARED}))""",
    "status_counts": f"SELECT value_status, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS percent FROM ({COMPARED}) GROUP BY 1",
    "file_match_rate": RATES,
    "review_gate": f"SELECT * FROM ({RATES}) WHERE match_rate < 0.75",
    "review_top10": f"""
SELECT l_suppkey, match_rate, array_to_string(lines[1:10], '|') AS lines, CAST(greatest(len(lines) - 10, 0) AS BIGINT) AS n_more FROM ({RATES}) r JOIN (
  SELECT l_suppkey, list(l_orderkey * 10 + l_linenumber ORDER BY l_orderkey * 10 + l_linenumber) AS lines FROM ({COMPARED}) WHERE value_status = 'mismatch' GROUP BY 1) m USING (l_suppkey) WHERE match_rate < 0.75""",
    "totals_check": _SUMS + _totals("stated - computed"),
    "totals_check_rev": _SUMS + _totals("computed - stated"),
    "schema_errors": """
WITH e AS (SELECT event_id AS file, event_id AS k FROM events),
live AS (SELECT * FROM e WHERE k % 11 = 0 OR k % 13 <> 0),
good AS (SELECT * FROM live WHERE k % 11 <> 0),
rows AS (SELECT * FROM good WHERE k % 17 <> 0)
SELECT file, 'unreadable' AS message FROM live WHERE k % 11 = 0
UNION ALL SELECT file, 'comuni is empty' FROM good WHERE k % 17 = 0
UNION ALL SELECT file, 'missing top-level key: provincia' FROM rows WHERE k % 4 = 0
UNION ALL SELECT file, 'comuni[0] (c): missing ''commercio_addetti''' FROM rows WHERE k % 7 = 0
UNION ALL SELECT file, 'comuni[0] (c): ''numero_ordine'' should be int|null' FROM rows WHERE k % 5 = 0""",
    "crosscheck_fields": """
WITH r AS (
  SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS a1, CASE WHEN l_linenumber <> 2 THEN CAST(l_quantity AS BIGINT) + CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END END AS b1,
    CAST(round(l_tax * 100) AS BIGINT) AS a2, CAST(round(l_discount * 100) AS BIGINT) AS b2, l_partkey AS a3, CASE WHEN l_linenumber % 2 = 0 THEN l_suppkey END AS b3 FROM lineitem)
SELECT *, left_value = right_value AS same FROM (
  SELECT l_orderkey, l_linenumber, 'a1' AS field, a1 AS left_value, b1 AS right_value FROM r UNION ALL SELECT l_orderkey, l_linenumber, 'a2', a2, b2 FROM r UNION ALL SELECT l_orderkey, l_linenumber, 'a3', a3, b3 FROM r)
WHERE left_value IS NOT NULL AND right_value IS NOT NULL""",
    "correct_rows": """
SELECT c_custkey AS row_id, c_mktsegment AS file, CASE WHEN c_custkey % 50 = 0 THEN 'renamed' ELSE c_name END AS name,
  CASE WHEN c_custkey % 10 = 0 AND c_custkey % 30 <> 0 THEN c_custkey * 2 ELSE CAST(round(c_acctbal) AS BIGINT) END AS value,
  c_custkey % 10 = 0 AND c_custkey % 30 <> 0 AS value_fixed, c_custkey % 50 = 0 AS name_fixed FROM customer""",
    "backfill": """
WITH f AS (SELECT s_suppkey % 70 AS norm, arg_min(CAST(round(s_acctbal) AS BIGINT), s_suppkey) AS fill FROM supplier WHERE s_suppkey % 2 = 0 AND s_acctbal IS NOT NULL GROUP BY 1)
SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN CAST(round(c_acctbal) AS BIGINT) ELSE fill END AS workers, c_custkey % 4 = 0 AND fill IS NOT NULL AS filled
FROM customer LEFT JOIN f ON c_custkey % 100 = norm""",
    "coverage": """
SELECT column_name, n_present, n_rows, round(100.0 * n_present / n_rows, 1) AS percent FROM (
  SELECT 'c_name' AS column_name, count(c_name) AS n_present, count(*) AS n_rows FROM customer
  UNION ALL SELECT 'c_acctbal', count(*) FILTER (WHERE c_custkey % 4 <> 0 AND c_acctbal IS NOT NULL), count(*) FROM customer
  UNION ALL SELECT 'c_mktsegment', count(nullif(c_mktsegment, 'BUILDING')), count(*) FROM customer)""",
    "panel_assembly": f"""WITH RECURSIVE {CLASSIFIED}
SELECT c.code, """
    + ", ".join(f"(SELECT CAST(sum(p.p_partkey * {m}) AS BIGINT) FROM part p WHERE list_contains(string_split(c.mapping_{k}, '|'), lpad(CAST(p.p_partkey AS VARCHAR), 6, '0'))) AS workers_{k}" for m, k in enumerate(_LABELS, 1))
    + " FROM classified c WHERE status = 'USABLE'",
    "queue_status": """
WITH d AS (SELECT doc_id, doc_id % 9 = 0 AS locked FROM documents), s AS (
  SELECT coalesce(d.doc_id, l.doc_id) AS i, d.doc_id IS NOT NULL AS listed, coalesce(locked, false) AS locked, l.doc_id IS NOT NULL AS has_out, coalesce(toxic = 1, false) AS skipped FROM d FULL JOIN labels l ON l.doc_id = d.doc_id)
SELECT count(*) FILTER (WHERE listed) AS total, count(*) FILTER (WHERE locked OR has_out) - count(*) FILTER (WHERE skipped) - count(*) FILTER (WHERE locked AND NOT has_out) AS completed,
  count(*) FILTER (WHERE locked AND NOT has_out) AS in_progress, count(*) FILTER (WHERE skipped) AS skipped, count(*) FILTER (WHERE listed AND NOT locked AND NOT has_out) AS remaining,
  min(printf('doc_%07d', i)) FILTER (WHERE listed AND NOT locked AND NOT has_out) AS next FROM s""",
    "remaining": "SELECT printf('doc_%07d', doc_id) AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "next_batch": "SELECT source || '_p' || doc_id AS key FROM documents WHERE source = 'src3' AND doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY key LIMIT 3",
    "remaining_by_region": "SELECT source AS region, count(*) AS n_pages FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 1",
    "page_pairs": """
WITH r AS (SELECT printf('page_%07d.png', page_id) AS name, (row_number() OVER (ORDER BY page_id) - 1) // 2 AS k FROM pages)
SELECT min(name) AS left_page, max(name) AS right_page FROM r GROUP BY k HAVING count(*) = 2""",
    "ledger_report": """
SELECT total, confirmed, corrected, not_found, round(100.0 * confirmed / total, 1) AS confirmed_percent, round(100.0 * corrected / total, 1) AS corrected_percent, round(100.0 * not_found / total, 1) AS not_found_percent FROM (
  SELECT count(*) AS total, count(*) FILTER (WHERE quality <> 0 AND toxic <> 1) AS confirmed, count(*) FILTER (WHERE quality <> 0 AND toxic = 1) AS corrected, count(*) FILTER (WHERE quality = 0) AS not_found FROM labels)""",
    "ratelimit_scan": """
SELECT doc_id, regexp_matches(t, '(?i)out of (extra )?usage|rate limit|quota exceeded|resets [0-9]') AS limited, regexp_extract(t, 'pair_[0-9]+') AS pair FROM (
  SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN substr(text, 1, 50) || ' Rate Limit pair_0007 ' || text ELSE text END AS t FROM documents)""",
    "digit_confusion": """
SELECT o_orderkey, len(x) = len(y) AND len(list_filter(d, lambda p: p[1] <> p[2])) > 0
  AND len(list_filter(d, lambda p: p[1] <> p[2] AND NOT (p[1] || p[2] IN ('09', '90', '06', '60', '23', '32')))) = 0 AS confused FROM (
  SELECT o_orderkey, x, y, list_transform(range(1, CAST(least(len(x), len(y)) + 1 AS BIGINT)), lambda i: [x[i], y[i]]) AS d FROM (
    SELECT o_orderkey, string_split(CAST(o_orderkey AS VARCHAR), '') AS x, string_split(CAST(CAST(translate(CAST(o_orderkey AS VARCHAR), '0236', '9320') AS BIGINT) AS VARCHAR), '') AS y FROM orders))""",
}

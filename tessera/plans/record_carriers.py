"""Carrier queries of readers, writers, documents, corrections and reports, each beside its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as N
from ..operators import corrections, matching, ocr, validation, workqueue
from ..operators.cut import scratch
from ..sources import readers, writers
from . import carriers
from .carriers import table
from .oracles import ORACLES as BASE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def carrier(sql: str):
    def add(query):
        QUERIES[query.__name__], ORACLES[query.__name__] = query, sql
        return query

    return add


@carrier("""
SELECT 'code' AS side, CAST(c_custkey % 500 AS VARCHAR) AS key, arg_max(lpad(CAST(c_custkey % 300 AS VARCHAR), 6, '0'), c_custkey) AS value FROM customer GROUP BY c_custkey % 500
UNION ALL SELECT 'id', lpad(CAST(c_custkey % 300 AS VARCHAR), 6, '0'), CAST(arg_max(c_custkey % 500, c_custkey) AS VARCHAR) FROM customer GROUP BY c_custkey % 300""")
def id_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select((k % 500).alias("sistat_id"), N.zero_fill((k % 300).cast("string")).alias("last_istat_cod"), k.alias("idx"))
    codes, ids = readers.id_maps(rows)
    return codes.select(F.lit("code").alias("side"), F.col("sistat_id").cast("string").alias("key"), F.col("code").alias("value")).unionByName(ids.select(F.lit("id").alias("side"), F.col("code").alias("key"), F.col("sistat_id").cast("string").alias("value")))


@carrier("SELECT upper(trim(regexp_replace(p_name, '\\s+', ' ', 'g'))) AS loose, CAST(max(p_partkey) AS BIGINT) AS idx FROM (SELECT p_partkey, regexp_replace(p_name, '[^A-Za-z0-9_ '']', '', 'g') AS p_name FROM part) GROUP BY 1")
def panel_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = table(spark, sf_dir, "part").select(F.col("p_name").alias("comune_matchable_50"), F.col("p_partkey").cast("long").alias("idx"))
    return readers.panel_by_name(panel).select("loose", "idx")


@carrier("SELECT CAST(c_nationkey AS BIGINT) AS nation, arg_min(c_name, c_custkey) AS first_name, arg_max(c_name, c_custkey) AS last_name FROM customer GROUP BY 1")
def first_last_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("long").alias("nation"), "c_name", F.col("c_custkey").alias("idx"))
    first = readers.first_rows(rows, "nation").select("nation", F.col("c_name").alias("first_name"))
    return first.join(readers.last_rows(rows, "nation").select("nation", F.col("c_name").alias("last_name")), "nation")


@carrier("""
SELECT c_custkey, f AS first_idx, l AS last_idx FROM customer LEFT JOIN (SELECT s_suppkey % 70 AS k, CAST(min(s_suppkey) AS BIGINT) AS f, CAST(max(s_suppkey) AS BIGINT) AS l FROM supplier GROUP BY 1) ON k = c_custkey % 97""")
def exact_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 97).alias("k"))
    panel = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("idx"), (F.col("s_suppkey") % 70).alias("k"))
    both = matching.exact_match(rows, panel, ["k"]).withColumnRenamed("panel_idx", "first_idx")
    return matching.exact_match(both, panel, ["k"], first=False).select("c_custkey", "first_idx", F.col("panel_idx").alias("last_idx"))


@carrier("""
WITH p AS (SELECT s_suppkey AS page, 'x' || chr(10) || CASE WHEN s_suppkey % 3 = 0 THEN 'Circondario di ' || s_name || ' . ' WHEN s_suppkey % 3 = 1 THEN '| CIRCONDARIO DI ' || s_name || ' |' ELSE ' CIRCONDARIO  DI ' || s_name END || chr(10) || '' AS md FROM supplier),
l AS (SELECT page, unnest(range(len(string_split(md, chr(10))))) AS line, unnest(string_split(md, chr(10))) AS t FROM p)
SELECT page, CAST(line AS BIGINT) AS line, nullif(regexp_extract(trim(t), '(?i)^CIRCONDARIO\\s+DI\\s+(.+?)[. ]*$', 1), '') AS header FROM l""")
def header_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, name = F.col("s_suppkey"), F.col("s_name")
    head = F.when(k % 3 == 0, F.concat(F.lit("Circondario di "), name, F.lit(" . "))).when(k % 3 == 1, F.concat(F.lit("| CIRCONDARIO DI "), name, F.lit(" |"))).otherwise(F.concat(F.lit(" CIRCONDARIO  DI "), name))
    pages = table(spark, sf_dir, "supplier").select(F.lit("r").alias("region"), k.alias("page"), F.concat(F.lit("x\n"), head, F.lit("\n")).alias("markdown"))
    return ocr.page_lines(pages).select("page", F.col("line").cast("long").alias("line"), ocr.circondario().alias("header"))


@carrier("SELECT o_orderkey, CASE WHEN o_orderkey % 7 >= 3 THEN '+' ELSE '' END || (o_orderkey % 7 - 3) AS diff FROM orders")
def signed_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", N.signed((F.col("o_orderkey") % 7 - 3).cast("long")).alias("diff"))


@carrier("SELECT count(*) AS n_pages, count(*) FILTER (WHERE source IS DISTINCT FROM 'src3') AS n_to_send, CAST(round(count(*) * 0.002, 6) AS DOUBLE) AS cost FROM documents")
def ocr_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "documents").select(F.col("source").alias("region"))
    return readers.ocr_cost(pages, pages.where("region = 'src3'"))


@carrier("SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 3 = 0 THEN DATE '2200-01-01' ELSE CAST(o_orderdate AS DATE) END AS VARCHAR) AS until FROM orders")
def live_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.when(F.col("o_orderkey") % 3 == 0, F.lit("9999-12-31").cast("date")).otherwise(F.col("o_orderdate").cast("date"))
    return table(spark, sf_dir, "orders").select("o_orderkey", N.live_end(end).cast("string").alias("until"))


@carrier("""
SELECT status, count(*) FILTER (WHERE side = 'b') AS n_before, count(*) FILTER (WHERE side = 'a') AS n_after FROM (
  SELECT 'b' AS side, CASE WHEN quality = 0 THEN 'mismatch' END AS status FROM labels UNION ALL SELECT 'a', CASE WHEN quality = 0 AND toxic = 0 THEN 'mismatch' WHEN quality = 0 THEN 'match' END FROM labels) GROUP BY status""")
def correction_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = F.col("quality") == 0
    rows = table(spark, sf_dir, "labels")
    before = rows.select(F.when(bad, "mismatch").alias("match_status"))
    return corrections.correction_counts(before, rows.select(F.when(bad & (F.col("toxic") == 0), "mismatch").when(bad, "match").alias("match_status")))


@carrier("""
SELECT o_orderkey, CASE WHEN n IS NOT NULL AND n <> o_orderstatus THEN o_custkey + 1 ELSE o_custkey END AS v, coalesce(n, o_orderstatus) AS match_status, n IS NOT NULL AND n <> o_orderstatus AS revalidated
FROM (SELECT *, CASE WHEN o_orderkey % 5 <> 0 THEN CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END END AS n FROM orders)""")
def refresh_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    old = o.select("o_orderkey", F.col("o_custkey").alias("v"), F.col("o_orderstatus").alias("match_status"))
    fresh = F.when(F.col("o_orderkey") % 5 != 0, F.when(F.col("o_orderkey") % 3 == 0, "X").otherwise(F.col("o_orderstatus")))
    return corrections.refresh_status(old, o.select("o_orderkey", (F.col("o_custkey") + 1).alias("v"), fresh.alias("match_status")), "o_orderkey", ["v"])


@carrier(f"""
SELECT n_empty, n_filled, n_empty - n_filled AS n_left FROM (SELECT count(*) FILTER (WHERE c_custkey % 4 = 0 OR c_acctbal IS NULL) AS n_empty FROM customer), (SELECT count(*) FILTER (WHERE filled) AS n_filled FROM ({BASE['backfill']}))""")
def fill_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = table(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 4 != 0, F.col("c_acctbal")).alias("workers"))
    return corrections.fill_counts(before, "workers", carriers.backfill(spark, sf_dir))


@carrier(f"""
WITH s AS (SELECT * FROM ({BASE['reconcile']})), c AS (SELECT * FROM ({BASE['crosscheck_fields']}))
SELECT (SELECT count(*) FROM customer WHERE c_mktsegment = 'BUILDING') AS n_exact, (SELECT count(*) FROM customer WHERE c_mktsegment = 'MACHINERY') AS n_fuzzy, (SELECT count(*) FROM s WHERE side = 'left_only') AS n_unmatched_left,
  (SELECT count(*) FROM s WHERE side = 'right_only') AS n_unmatched_right, (SELECT count(*) FROM c) AS total_checks, (SELECT count(*) FROM c WHERE same) AS total_correct, (SELECT round(100.0 * count(*) FILTER (WHERE same) / nullif(count(*), 0), 1) FROM c) AS accuracy""")
def field_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("c_mktsegment") == "BUILDING", "exact").when(F.col("c_mktsegment") == "MACHINERY", "fuzzy").otherwise("none")
    sides = carriers.reconcile(spark, sf_dir)
    return validation.field_accuracy(table(spark, sf_dir, "customer").select(kind.alias("match_type")), carriers.crosscheck_fields(spark, sf_dir), sides.where("side = 'left_only'"), sides.where("side = 'right_only'"), equal="same")


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    text = k.cast("string")
    entry = (
        F.when(k % 4 == 0, F.concat(F.lit('{"complesso_addetti":null,"complesso_esercizi":'), text, F.lit(',"commercio_esercizi":1}')))
        .when(k % 4 == 1, F.concat(F.lit('{"commercio_esercizi":null,"industria_addetti":'), text, F.lit("}")))
        .when(k % 4 == 2, F.concat(F.lit('{"commercio_esercizi":1,"industria_addetti":null,"industria_esercizi":"'), text, F.lit('.7"}')))
        .otherwise(F.lit('{"commercio_esercizi":1,"industria_addetti":1,"vendita_liquori":null,"industria_esercizi":"x"}'))
    )
    docs = table(spark, sf_dir, "events").select(k.alias("file"), F.concat(F.lit('{"comuni":['), entry, F.lit("]}")).alias("value"))
    return validation.document_rows(validation.parse_documents(docs))


ENTRIES = """SELECT event_id AS file, CAST(CASE event_id % 4 WHEN 0 THEN '{"complesso_addetti":null,"complesso_esercizi":' || event_id || ',"commercio_esercizi":1}' WHEN 1 THEN '{"commercio_esercizi":null,"industria_addetti":' || event_id || '}'
  WHEN 2 THEN '{"commercio_esercizi":1,"industria_addetti":null,"industria_esercizi":"' || event_id || '.7"}' ELSE '{"commercio_esercizi":1,"industria_addetti":1,"vendita_liquori":null,"industria_esercizi":"x"}' END AS JSON) AS j FROM events"""
DETECTED = f"""SELECT file, j, CASE WHEN list_contains(json_keys(j), 'complesso_addetti') THEN 'NEW' WHEN j->>'commercio_esercizi' IS NULL THEN 'LEGACY_C' WHEN j->>'industria_addetti' IS NULL THEN 'LEGACY_B' WHEN j->>'vendita_liquori' IS NULL THEN 'LEGACY_A' ELSE 'LEGACY_UNK' END AS phase FROM ({ENTRIES})"""


@carrier(f"""
SELECT file, phase, field, CAST(trunc(TRY_CAST(j->>field AS DOUBLE)) AS BIGINT) AS value FROM (
  SELECT *, CASE phase WHEN 'NEW' THEN 'complesso_addetti' WHEN 'LEGACY_C' THEN 'industria_addetti' ELSE 'industria_esercizi' END AS field FROM ({DETECTED}))""")
def detect_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _entries(spark, sf_dir)
    return rows.join(validation.detect_field(rows), "file").select("file", "phase", "field", validation.field_value("row", F.col("field")).alias("value"))


@carrier(f"""
SELECT file, CASE WHEN list_contains(json_keys(j), 'complesso_esercizi') THEN 'commercio_addetti|complesso_esercizi|complesso_addetti|vendita_vino|vendita_liquori'
  ELSE 'commercio_addetti|commercio_esercizi|industria_esercizi|industria_addetti|vendita_vino|vendita_liquori' END AS fields FROM ({ENTRIES})""")
def schema_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entries(spark, sf_dir).select("file", F.array_join(validation.schema_fields(F.col("keys")), "|").alias("fields"))


@carrier("SELECT file, " + ", ".join(f"CAST(trunc(TRY_CAST(j->>'{f}' AS DOUBLE)) AS BIGINT) AS {f}" for f in dict.fromkeys(validation.NEW_FIELDS + validation.OLD_FIELDS)) + f" FROM ({ENTRIES})")
def all_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entries(spark, sf_dir).select("file", validation.all_fields().alias("f")).select("file", "f.*")


@carrier("""
SELECT file, CASE WHEN NOT json_valid(v) THEN 'unreadable' ELSE 'no comuni' END AS error FROM (
  SELECT event_id AS file, CASE WHEN event_id % 11 = 0 THEN '{broken' WHEN event_id % 13 = 0 THEN '{"_skip":true}' WHEN event_id % 17 = 0 THEN '{"comuni":[]}' ELSE '{"comuni":[{"comune":"c"}]}' END AS v FROM events)
WHERE NOT json_valid(v) OR coalesce(json_array_length(CASE WHEN json_valid(v) THEN v END, '$.comuni'), 0) = 0""")
def document_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    doc = F.when(k % 11 == 0, "{broken").when(k % 13 == 0, '{"_skip":true}').when(k % 17 == 0, '{"comuni":[]}').otherwise('{"comuni":[{"comune":"c"}]}')
    return readers.document_problems(validation.parse_documents(table(spark, sf_dir, "events").select(k.alias("file"), doc.alias("value"))))


@carrier("""
WITH t AS (SELECT CAST('{"' || c_mktsegment || '":{"' || c_name || '":' || CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE '{"corrected_name":"n' || c_custkey || '","ind_workers":' || c_custkey * 2 || '}' END || '}}' AS JSON) AS j FROM customer),
f AS (SELECT json_keys(j)[1] AS file, json_extract(j, '$."' || json_keys(j)[1] || '"') AS e FROM t), n AS (SELECT file, json_keys(e)[1] AS name, json_extract(e, '$."' || json_keys(e)[1] || '"') AS v FROM f)
SELECT file, name, CAST(CASE WHEN json_type(v) = 'OBJECT' THEN v->>'ind_workers' ELSE CAST(v AS VARCHAR) END AS BIGINT) AS new_value, CASE WHEN json_type(v) = 'OBJECT' THEN v->>'corrected_name' END AS new_name FROM n""")
def parse_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    value = F.when(k % 2 == 0, k.cast("string")).otherwise(F.concat(F.lit('{"corrected_name":"n'), k.cast("string"), F.lit('","ind_workers":'), (k * 2).cast("string"), F.lit("}")))
    text = F.concat(F.lit('{"'), F.col("c_mktsegment"), F.lit('":{"'), F.col("c_name"), F.lit('":'), value, F.lit("}}"))
    return corrections.parse_corrections(table(spark, sf_dir, "customer").select(text.alias("value")))


@carrier("""
WITH t AS (SELECT CAST('{"k' || s_suppkey || '":[{"search_name":"' || s_name || '","popres_1921_tot":' || s_suppkey || '},{"search_name":"b","analfabeti_1921":' || s_nationkey || '}]}' AS JSON) AS j FROM supplier),
u AS (SELECT json_keys(j)[1] AS key, unnest(CAST(json_extract(j, '$.' || json_keys(j)[1]) AS JSON[])) AS r FROM t)
SELECT key, r->>'search_name' AS search_name, CAST(r->>'popres_1921_tot' AS BIGINT) AS popres_1921_tot, CAST(r->>'popres_1921_f' AS BIGINT) AS popres_1921_f, CAST(r->>'analfabeti_1921' AS BIGINT) AS analfabeti_1921 FROM u""")
def validation_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey").cast("string")
    text = F.concat(F.lit('{"k'), s, F.lit('":[{"search_name":"'), F.col("s_name"), F.lit('","popres_1921_tot":'), s, F.lit('},{"search_name":"b","analfabeti_1921":'), F.col("s_nationkey").cast("string"), F.lit("}]}"))
    return readers.read_validation_lookup(table(spark, sf_dir, "supplier").select(text.alias("value")))


@carrier("SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 2 THEN l_quantity END >= l_linenumber * 8 AS sound FROM lineitem")
def plausible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", N.plausible(F.when(F.col("l_linenumber") != 2, F.col("l_quantity")), F.col("l_linenumber") * 8).alias("sound"))


@carrier("SELECT CAST(n_nationkey AS BIGINT) AS volume, CAST(unnest(generate_series(n_regionkey, n_regionkey + n_nationkey)) AS BIGINT) AS page FROM nation")
def page_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.col("n_regionkey").cast("long")
    return workqueue.page_range(table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("volume"), first.alias("first"), (first + F.col("n_nationkey")).cast("long").alias("last")))


@carrier("SELECT printf('pair_%04d', range) AS id FROM range(188) WHERE range NOT IN (SELECT doc_id FROM labels UNION SELECT page_id FROM pages WHERE url IS NULL)")
def open_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "labels").select(F.format_string("pair_%04d", "doc_id").alias("id"))
    locks = table(spark, sf_dir, "pages").where("url is null").select(F.format_string("pair_%04d", "page_id").alias("id"))
    return workqueue.pending(workqueue.pair_inventory(spark), workqueue.done_ids(done, locks), "id")


@carrier(f"SELECT level, count(*) AS n FROM ({BASE['match_cascade']}) GROUP BY level")
def level_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.level_counts(carriers.match_cascade(spark, sf_dir))


@carrier("SELECT count(*) AS n_records, count(DISTINCT n_name) AS n_provinces FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def merge_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    return writers.merge_documents(rows.select(F.col("n_name").alias("provincia")))


@carrier("""
SELECT s_name AS comune_raw, coalesce(CASE WHEN s_suppkey % 3 <> 0 THEN s_name END, '') AS comune_matched, 'exact' AS match_type, printf('%.3f', CAST(s_suppkey % 8 AS DOUBLE) / 8) AS match_score, 'r' AS region, '' AS circondario,
  CAST(s_suppkey AS VARCHAR) AS popres_1921_tot, '' AS popres_1921_f, CAST(s_nationkey AS VARCHAR) AS analfabeti_1921 FROM supplier""")
def population_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    none, k = F.lit(None).cast("string"), F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier")
    return writers.population_rows(
        s.select(
            F.col("s_name").alias("comune_raw"), F.when(k % 3 != 0, F.col("s_name")).alias("comune_matched"), F.lit("exact").alias("match_type"), ((k % 8).cast("double") / 8).alias("match_score"), F.lit("r").alias("region"),
            none.alias("circondario"), k.alias("popres_1921_tot"), none.alias("popres_1921_f"), F.col("s_nationkey").alias("analfabeti_1921"),
        )
    )


@carrier("SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 1 THEN '+' ELSE '' END || (o_orderkey % 5 - 1) AS diff FROM orders WHERE o_orderkey % 5 <> 1")
def report_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    left, right = (F.col("o_orderkey") % 5).cast("long"), F.lit(1).cast("long")
    checks = o.select("o_orderkey", left.alias("left"), right.alias("right"), (left == right).alias("same"))
    links = o.select("o_orderkey", F.lit("fuzzy").alias("match_type"), F.lit(0.9).alias("match_score"))
    return writers.match_report(links, links.where("match_type = 'none'"), checks)["mismatches"].select("o_orderkey", "diff")


@carrier("""
SELECT CASE WHEN length(c) < 6 THEN lpad(c, 6, '0') ELSE c END AS code, CASE WHEN c_custkey % 4 = 0 THEN 'NA' ELSE c_mktsegment END AS key, trim(c_name) AS name, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'AB' END AS sigla,
  CASE WHEN c_custkey % 6 <> 0 THEN CAST(DATE '1900-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS VARCHAR) END AS start, CASE WHEN c_custkey % 3 = 0 THEN '2200-01-01' ELSE '1950-06-30' END AS until
FROM (SELECT *, CAST(c_custkey AS VARCHAR) AS c FROM customer)""")
def registry_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry's columns written in a fixed order and read again."""
    k, path = F.col("c_custkey"), scratch(spark)
    rows = table(spark, sf_dir, "customer").select(
        F.lit("x").alias("extra"), F.concat(F.lit(" "), k.cast("string"), F.lit(" ")).alias("CODISTAT"), F.when(k % 4 == 0, "NA").otherwise(F.col("c_mktsegment")).alias("CODCATASTALE"), F.concat(F.col("c_name"), F.lit("  ")).alias("DENOMTRASLITTERATA"),
        F.when(k % 5 != 0, "AB").alias("SIGLAPROVINCIA"), F.when(k % 6 == 0, "unknown").otherwise(F.concat(F.date_add(F.lit("1900-01-01").cast("date"), (k % 1000).cast("int")).cast("string"), F.lit(" 00:00:00"))).alias("DATAISTITUZIONE"),
        F.when(k % 3 == 0, "9999-12-31").otherwise("1950-06-30").alias("DATACESSAZIONE"),
    )
    writers.write_csv(rows, path, list(readers.REGISTRY))
    return readers.read_registry(spark, path).select("code", "key", "name", "sigla", F.col("start").cast("string").alias("start"), F.col("end").cast("string").alias("until"))


@carrier("""
SELECT s_name AS csv_name, CAST(s_suppkey AS BIGINT) AS popres_1921_tot, status, count(*) AS n FROM supplier, (VALUES ('CONFIRMED'), ('CORRECTED')) v(status) GROUP BY ALL""")
def ledger_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An absent ledger is empty; two appends give two rows of each name."""
    path, none = scratch(spark), F.lit(None)
    rows = lambda state: table(spark, sf_dir, "supplier").select(F.col("s_name").alias("csv_name"), F.col("s_suppkey").cast("long").alias("popres_1921_tot"), none.cast("long").alias("popres_1921_f"), none.cast("long").alias("analfabeti_1921"), F.lit(state).alias("status"), none.cast("string").alias("note"))
    absent = readers.read_or_empty(spark, path)
    writers.append_ledger(absent.unionByName(rows("CONFIRMED")), path)
    writers.append_ledger(rows("CORRECTED"), path)
    return readers.read_or_empty(spark, path).groupBy("csv_name", "popres_1921_tot", "status").agg(F.count(F.lit(1)).alias("n"))

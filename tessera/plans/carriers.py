"""Carrier queries: each runs reference-side operators over whole synthetic tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as N
from ..operators import corrections, lineage, matching, ocr, temporal, validation, workqueue

#: Dates at which the synthetic entities are counted, and numbers to hold them against.
CENSUS = {"1921": "1996-12-01", "1927": "1997-10-15", "1929": "1998-10-15"}
REF = "1999-06-15"
EXPECTED = {"1921": 4109, "1927": 5772, "1929": 7000, "ref": 7546}
LABELS = list(CENSUS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as entities: from the order's date to its last shipping date."""
    ends = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").cast("date").alias("end"))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("code"), F.col("o_orderdate").cast("date").alias("start")).join(ends, F.col("code") == F.col("l_orderkey")).drop("l_orderkey")


def alive_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.alive_counts(temporal.alive_sets(intervals(spark, sf_dir), CENSUS | {"ref": REF}))


def alive_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.alive_drift(alive_sets(spark, sf_dir), EXPECTED)


def _codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(N.zero_fill(F.col("p_partkey").cast("string")).alias("code"), F.col("p_name").alias("key"), F.col("p_type").alias("name"), F.col("p_partkey").alias("idx"), "p_partkey")


def _ref30(codes: DataFrame) -> DataFrame:
    return codes.where("p_partkey % 30 = 0").select("code")


def key_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = _codes(spark, sf_dir).withColumn("key", F.concat("key", F.lit("/"), F.floor(F.col("p_partkey") / 50).cast("string")))
    return lineage.key_bridge(codes, _ref30(codes))


def _edges(codes: DataFrame) -> DataFrame:
    halves = codes.select(F.col("code").alias("src"), F.floor(F.col("p_partkey") / 2).cast("string").alias("dst"))
    thirds = codes.select(F.col("code").alias("src"), F.floor(2 * F.col("p_partkey") / 3).cast("string").alias("dst"))
    return halves.union(thirds).select("src", N.zero_fill(F.col("dst")).alias("dst")).where("dst <> '000000'")


def _ref97(codes: DataFrame) -> DataFrame:
    return codes.where("p_partkey % 97 = 0").select("code")


def lineage_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = _codes(spark, sf_dir)
    return lineage.closure(_edges(codes), _ref97(codes))


def _forward(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    codes = _codes(spark, sf_dir).withColumn("key", F.concat("key", F.lit("/"), F.floor(F.col("p_partkey") / 200).cast("string")))
    ref = _ref97(codes)
    bridge = lineage.key_bridge(codes, ref)
    reach = lineage.closure(_edges(codes).where("cast(src as int) % 5 <> 0"), ref)
    rescue = lineage.fallback(codes.where("p_partkey % 5 = 0"), ref, bridge)
    alive = codes.select(F.explode(F.array(*[F.when(F.col("p_partkey") % k != 0, F.lit(label)) for label, k in zip(LABELS, (2, 3, 7), strict=True)])).alias("label"), "code").where("label is not null")
    return lineage.forward_mapping(alive, ref, bridge, reach, rescue), ref, alive


def forward_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _forward(spark, sf_dir)[0].select("label", "code", "method", F.array_join("dest", "|").alias("dest"))


def method_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.method_counts(_forward(spark, sf_dir)[0])


def split_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.split_children(_forward(spark, sf_dir)[0])


def reverse_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    forward, ref, alive = _forward(spark, sf_dir)
    return lineage.classify(forward, ref, alive, LABELS)


def reason_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.reason_histogram(reverse_classify(spark, sf_dir))


def territory_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    events = e.select(F.col("user_id").alias("entity"), (F.col("event_id") % 1000).alias("event_num"), "event_type", F.col("ts").cast("date").alias("event_date"))
    users = e.select(F.col("user_id").alias("entity"), F.col("user_id").alias("code"), F.col("event_id").alias("idx"))
    other = e.where("event_type = 'view'").select((F.col("event_id") % 1000).alias("event_num"), (F.col("user_id") + 1).alias("to_code"))
    ref = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("code"))
    bounds = ("2024-01-02", "2024-01-03")
    return lineage.territory_flags(events, users, [(other, "to_code")], ref, *bounds, kinds=("click", "purchase"))


def match_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key = lambda c: F.regexp_replace(F.col(c), "^[A-Za-z#]+0*", "")
    c = table(spark, sf_dir, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    s = table(spark, sf_dir, "supplier").join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
    entities = c.select(F.col("c_custkey").cast("string").alias("code"), key("c_name").alias("name"), F.col("n_name").alias("province"))
    panel = s.select(F.col("s_suppkey").alias("idx"), key("s_name").alias("name"), F.col("n_name").alias("province"))
    return matching.match_cascade(entities, panel, {"NATION_1": "NATION_2", "FRANCE": "GERMANY"}, {"3": "7", "200": "9", "201": "none"}).select("code", "level", "panel_idx")


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.regexp_replace("text", "ß", "ss").alias("name"))


def norm_n1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("doc_id", N.plain_name(F.col("name")).alias("norm"), N.match_name(F.col("name")).alias("loose"))


def norm_n3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("doc_id", N.accent_name(F.col("name")).alias("norm"))


def norm_n4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("doc_id", N.loose_name(F.col("name")).alias("norm"))


def pad_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey").cast("string")).alias("k"))
    text = F.when(F.col("c_custkey") % 7 == 0, F.lit(None)).when(F.col("c_custkey") % 3 == 0, F.concat("k", F.lit(".0"))).when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("12345"), "k")).otherwise(F.col("k"))
    return keys.select("c_custkey", N.pad_code(text).alias("code"), N.province_prefix(N.pad_code(text)).alias("province"))


def title_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    text = F.when(F.col("p_partkey") % 4 == 0, F.regexp_replace("p_type", " ", "'")).when(F.col("p_partkey") % 4 == 1, F.regexp_replace("p_type", " ", "-")).otherwise(F.col("p_type"))
    return p.select("p_partkey", N.title_case(text).alias("title"))


def parse_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") * 137).alias("v"))
    k = F.col("o_orderkey") % 8
    text = (
        F.when(k == 0, "..").when(k == 1, "—").when(k == 2, F.concat((F.col("v") / 1000).cast("long").cast("string"), F.lit(" "), F.lpad((F.col("v") % 1000).cast("string"), 3, "0")))
        .when(k == 3, F.concat(F.col("v").cast("string"), F.lit(" *"))).when(k == 4, F.concat(F.lit("-"), F.col("v").cast("string"))).when(k == 5, "12-34").when(k == 6, " ").otherwise(F.col("v").cast("string"))
    )
    return o.select("o_orderkey", N.parse_number(text).alias("number"), F.coalesce(N.number_error(text), F.lit(False)).alias("spoilt"), N.to_int(F.concat(text, F.lit(".7"))).alias("cut"))


def _md_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    s = table(spark, sf_dir, "supplier").join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
    k = F.col("s_suppkey")
    name = F.when(k % 11 == 0, F.concat(F.lit("Totale "), "n_name")).when(k % 13 == 0, F.lit("COMUNI")).otherwise(F.col("s_name"))
    men = F.when(k % 5 == 0, "..").otherwise((k * 3).cast("string"))
    women = F.when(k % 17 == 0, "1-2").otherwise((k * 4).cast("string"))
    cells = F.concat_ws(" | ", name, (k * 7 + 1).cast("string"), men, women, F.when(k % 7 == 0, "").otherwise((k * 5).cast("string")), F.lit("1"), F.lit("2"))
    line = F.when(k % 19 == 0, F.lit("|---|---|---|---|---|---|---|")).otherwise(F.concat(F.lit("| "), cells, F.lit(" |")))
    return s.select(F.col("n_name").alias("region"), F.col("s_suppkey").alias("page"), F.lit(0).alias("line"), line.alias("text"))


def md_table_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ocr.parse_rows(_md_rows(spark, sf_dir)).select("region", "page", "comune_raw", "popres_1921_tot", "popres_1921_f", "analfabeti_1921", "mf_literate")


def carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").withColumn("header", F.when(F.col("turn") % 3 == 0, F.col("text")))
    return ocr.carry_header(c, "conv_id", ["turn"], "header", "carried").select("conv_id", "turn", "carried")


def sequence_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").withColumn("number", F.when((F.col("turn") % 3 != 1) & (F.col("turn") % 5 != 4), F.col("turn") + 1))
    return validation.sequence_breaks(c, "conv_id", "turn", "number").select("conv_id", "turn", "number", "expected")


def _names(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p = table(spark, sf_dir, "part")
    panel = p.groupBy("p_name").agg(F.min("p_partkey").alias("idx")).select("idx", F.upper("p_name").alias("norm"), F.lit("x").alias("province"), F.lit("R").alias("region"))
    words = p.select(F.col("p_partkey").alias("row_id"), F.when(F.col("p_partkey") % 3 == 0, F.upper("p_name")).otherwise(F.regexp_replace(F.upper("p_name"), "[AE]", "Y")).alias("norm"), F.when(F.col("p_partkey") % 2 == 0, F.lit("x")).alias("province"), F.lit("R").alias("region"))
    return words, panel


def fuzzy_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    words, panel = _names(spark, sf_dir)
    return matching.link_names(words.select("row_id", "province", "norm"), panel)


def fuzzy_f2(spark: SparkSession, sf_dir: str) -> DataFrame:
    words, panel = _names(spark, sf_dir)
    return matching.link_regions(words.select("row_id", "region", "norm"), panel, {"R": ["x"]})


def fuzzy_length_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    words, panel = _names(spark, sf_dir)
    return matching.length_pairs(words.select(F.col("norm").alias("word")), panel.select(F.col("norm").alias("name")), 0.85)


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.reconcile(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    l = table(spark, sf_dir, "lineitem").join(price, F.col("l_partkey") == F.col("p_partkey"))  # noqa: E741
    k = F.col("l_orderkey") + F.col("l_linenumber")
    extracted = F.when(k % 11 == 0, F.lit(None)).when(k % 13 == 0, F.lit(0)).otherwise(F.round(F.col("l_extendedprice")).cast("long"))
    reference = F.when(k % 17 == 0, F.lit(None)).otherwise(F.round(F.col("l_quantity") * F.col("p_retailprice") * (1 + (k % 5 - 2) * 0.07)))
    rows = l.select("l_suppkey", "l_orderkey", "l_linenumber", extracted.cast("long").alias("extracted"), reference.cast("double").alias("reference"))
    return validation.with_value_status(rows, "extracted", "reference")


def tolerance_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(spark, sf_dir).select("l_orderkey", "l_linenumber", "extracted", "value_status", "exact_equal")


def compare_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.compare_tally(_compared(spark, sf_dir).withColumn("name_status", F.when(F.col("l_suppkey") % 9 == 0, "no_ref").otherwise("exact")))


def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.status_counts(_compared(spark, sf_dir), ["value_status"])


def file_match_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.match_rates(_compared(spark, sf_dir), "l_suppkey")


def review_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.review_gate(file_match_rate(spark, sf_dir), 0.75)


def review_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _compared(spark, sf_dir).withColumn("line", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    rates = validation.match_rates(rows, "l_suppkey")
    manifest = validation.review_manifest(rows, validation.review_gate(rates, 0.75), "l_suppkey", ["line"], F.col("value_status") == "mismatch", "line", 10)
    return manifest.select("l_suppkey", "match_rate", F.array_join(F.transform("mismatches", lambda x: x["line"].cast("string")), "|").alias("lines"), F.col("n_more").cast("long").alias("n_more"))


def _order_totals(spark: SparkSession, sf_dir: str, reverse: bool) -> DataFrame:
    cents = lambda c: F.round(F.col(c) * 100).cast("long")
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), cents("l_extendedprice").alias("price"), F.when(F.col("l_linenumber") != 3, cents("l_quantity")).alias("quantity"))
    stated = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), cents("o_totalprice").alias("price"), F.when(F.col("o_orderkey") % 4 != 0, F.lit(5000)).cast("long").alias("quantity"))
    return validation.totals_check(rows, stated, "key", ["price", "quantity"], reverse)


def totals_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_totals(spark, sf_dir, False)


def totals_check_rev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_totals(spark, sf_dir, True)


def schema_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("file"), F.col("event_id").alias("i"), F.get_json_object("props", "$.k").alias("k"))
    k = F.col("i")
    entry = F.concat(F.lit('{"comune":"c","numero_ordine":'), F.when(k % 5 == 0, '"x"').otherwise(F.col("k")), F.lit(',"complesso_esercizi":1,"complesso_addetti":null,"commercio_esercizi":'), F.when(k % 3 == 0, "true").otherwise("2.5"), F.when(k % 7 == 0, "").otherwise(',"commercio_addetti":3'), F.lit(',"vendita_vino":1}'))
    doc = F.when(k % 11 == 0, F.lit("{broken")).when(k % 13 == 0, F.lit('{"_skip":true}')).when(k % 17 == 0, F.lit('{"provincia":"p","comuni":[]}')).otherwise(F.concat(F.lit('{"comuni":['), entry, F.lit("]"), F.when(k % 4 == 0, "").otherwise(',"provincia":"p"'), F.lit("}")))
    return validation.schema_errors(validation.parse_documents(e.select("file", doc.alias("value"))))


def crosscheck_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    k = F.col("l_linenumber")
    rows = l.select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("long").alias("a1"), F.when(k != 2, F.col("l_quantity") + (k == 3).cast("int")).cast("long").alias("b1"), F.round(F.col("l_tax") * 100).cast("long").alias("a2"), F.round(F.col("l_discount") * 100).cast("long").alias("b2"), F.col("l_partkey").alias("a3"), F.when(k % 2 == 0, F.col("l_suppkey")).alias("b3"))
    return validation.crosscheck(rows, ["l_orderkey", "l_linenumber"], [("a1", "b1"), ("a2", "b2"), ("a3", "b3")]).select("l_orderkey", "l_linenumber", "field", F.col("left").alias("left_value"), F.col("right").alias("right_value"), "same")


def correct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    rows = c.select(F.col("c_custkey").alias("row_id"), F.col("c_mktsegment").alias("file"), F.col("c_name").alias("name"), F.round("c_acctbal").cast("long").alias("value"))
    fixes = c.where("c_custkey % 10 = 0").select(F.col("c_mktsegment").alias("file"), F.when(F.col("c_custkey") % 20 == 0, F.lower("c_name")).otherwise(F.col("c_name")).alias("name"), F.when(F.col("c_custkey") % 30 != 0, F.col("c_custkey") * 2).alias("new_value"), F.when(F.col("c_custkey") % 50 == 0, F.lit("renamed")).alias("new_name"))
    return corrections.apply_corrections(rows, fixes)


def backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    gaps = c.select("c_custkey", (F.col("c_custkey") % 100).cast("string").alias("norm"), F.when(F.col("c_custkey") % 4 != 0, F.round("c_acctbal").cast("long")).alias("workers"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("idx"), (F.col("s_suppkey") % 70).cast("string").alias("csv_name"), F.round("s_acctbal").cast("long").alias("value"), F.when(F.col("s_suppkey") % 2 == 0, "exact:match").otherwise("no_ref:csv_empty").alias("match_status"))
    return corrections.backfill(gaps, corrections.usable_fills(s, "value", "csv_name", "idx"), "workers").select("c_custkey", "workers", "filled")


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_name", F.when(F.col("c_custkey") % 4 != 0, F.col("c_acctbal")).alias("c_acctbal"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"))
    return corrections.coverage(c, ["c_name", "c_acctbal", "c_mktsegment"])


def panel_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = {k: _codes(spark, sf_dir).select("code", (F.col("p_partkey") * m).alias("workers")) for m, k in enumerate(LABELS, 1)}
    return corrections.assemble_panel(reverse_classify(spark, sf_dir), measures)


def queue_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.format_string("doc_%07d", "doc_id").alias("id"), "doc_id")
    l = table(spark, sf_dir, "labels").select(F.format_string("doc_%07d", "doc_id").alias("id"), (F.col("toxic") == 1).alias("skipped"))  # noqa: E741
    return workqueue.queue_status(d, l, d.where("doc_id % 9 = 0"))


def remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.format_string("doc_%07d", "doc_id").alias("id"))
    l = table(spark, sf_dir, "labels").select(F.format_string("doc_%07d", "doc_id").alias("id"))  # noqa: E741
    return workqueue.remaining(d, l)


def _page_keys(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    d = table(spark, sf_dir, "documents").select(F.concat("source", F.lit("_p"), F.col("doc_id").cast("string")).alias("key"), "doc_id")
    return d.select("key"), d.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi").select("key")


def next_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workqueue.next_batch(*_page_keys(spark, sf_dir), 3, "src3")


def remaining_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workqueue.remaining_by_region(*_page_keys(spark, sf_dir))


def page_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.format_string("page_%07d.png", "page_id").alias("name"))
    return workqueue.page_pairs(pages).select("left_page", "right_page")


def ledger_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "labels")  # noqa: E741
    return workqueue.ledger_report(l.select(F.when(F.col("quality") == 0, "NOT_FOUND").when(F.col("toxic") == 1, "CORRECTED").otherwise("CONFIRMED").alias("status")))


def ratelimit_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    log = F.when(F.col("doc_id") % 10 == 0, F.concat(F.substring("text", 1, 50), F.lit(" Rate Limit pair_0007 "), "text")).otherwise(F.col("text"))
    return d.select("doc_id", N.rate_limited(log).alias("limited"), N.pair_id(log).alias("pair"))


def digit_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").alias("a"), F.translate(F.col("o_orderkey").cast("string"), "0236", "9320").cast("long").alias("b"))
    return o.select("o_orderkey", N.confused_digits(F.col("a"), F.col("b")).alias("confused"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        alive_sets, alive_drift, key_bridge, lineage_closure, forward_cascade, method_counts, split_children, reverse_classify, reason_histogram, territory_flag,
        match_cascade, norm_n1, norm_n3, norm_n4, pad_code, title_case, parse_number, md_table_parse, carry_forward, sequence_check,
        fuzzy_f1, fuzzy_f2, fuzzy_length_bound, reconcile, tolerance_compare, compare_tally, status_counts, file_match_rate, review_gate, review_top10,
        totals_check, totals_check_rev, schema_errors, crosscheck_fields, correct_rows, backfill, coverage, panel_assembly,
        queue_status, remaining, next_batch, remaining_by_region, page_pairs, ledger_report, ratelimit_scan, digit_confusion,
    )
}

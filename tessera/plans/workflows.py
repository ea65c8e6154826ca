"""The four workflows end to end: crosswalk, linkage of extractions, OCR population linkage, work queue of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import accent_name, loose_name, modern_province
from ..operators import corrections, lineage, matching, ocr, temporal, validation
from ..operators.cut import cut
from ..sources import dimensions, readers


def build_crosswalk(registry: DataFrame, tables: dict[str, DataFrame], panel: DataFrame, dates: dict[str, str] = temporal.CENSUS_DATES, reference: str = temporal.REFERENCE_DATE) -> dict[str, DataFrame]:
    """Entry 1: forward mapping, classification, panel match and territory flags, from a registry and lineage tables.

    Returns ``alive``, ``forward`` and ``crosswalk``, the last in the columns of :data:`tessera.sources.writers.CROSSWALK`.
    """
    labels = list(dates)
    alive = temporal.alive_sets(registry, dates)
    ref = temporal.alive_at(registry, reference)
    by_id, _ = readers.id_maps(tables["comuni"])
    edges = tables["event_extinction"].join(by_id, "sistat_id").select(F.col("code").alias("src"), F.col("event_to_istat_cod").alias("dst"))
    bridge = lineage.key_bridge(registry, ref)
    forward = lineage.forward_mapping(alive, ref, bridge, lineage.closure(edges, ref), lineage.fallback(registry, ref, bridge))
    events = tables["comuni_variations"].withColumnRenamed("sistat_id", "entity")
    entities = tables["comuni"].select(F.col("sistat_id").alias("entity"), F.col("last_istat_cod").alias("code"), "idx")
    flags = lineage.territory_flags(events, entities, [(tables["event_territory_acquisition"], "event_from_istat_cod"), (tables["event_territory_cession"], "event_to_istat_cod")], ref)
    classified = lineage.classify(forward, ref, alive, labels, flags)
    at_ref = registry.where(temporal.alive_when(F.col("start"), F.col("end"), F.lit(reference).cast("date")))
    info = at_ref.groupBy("code").agg(F.max_by(F.struct("name", "sigla"), "idx").alias("i")).select("code", F.col("i.name").alias("name_1950"), F.col("i.sigla").alias("sigla"))
    signs = F.create_map(*[F.lit(x) for p in dimensions.SIGLA_PROVINCES.items() for x in p])
    named = classified.join(info, "code", "left").withColumn("province_1950", F.coalesce(F.try_element_at(signs, F.col("sigla")), F.col("sigla"), F.lit("")))
    entities = named.select("code", F.coalesce("name_1950", F.lit("")).alias("name"), F.col("province_1950").alias("province"))
    listed = panel.select("idx", F.col("comune_matchable_50").alias("name"), "province")
    matched = matching.match_cascade(entities, listed, dimensions.PROVINCE_ALIASES, dimensions.NAME_OVERRIDES).select("code", "level", F.col("panel_idx").alias("idx"))
    linked = matched.join(listed.select("idx", F.col("name").alias("csv_name_match")), "idx", "left").drop("idx")
    crosswalk = named.join(linked, "code", "left").withColumnRenamed("code", "codistat_1950")
    return {"alive": alive, "forward": forward, "crosswalk": crosswalk}


def link_extractions(texts: DataFrame, panel: DataFrame) -> dict[str, DataFrame]:
    """Entry 2, extract and review: rows of all documents linked and compared, files' rates, and what needs review.

    ``texts`` has file and value; ``panel`` comes from :func:`tessera.sources.readers.read_panel`.
    """
    parsed = validation.parse_documents(texts)
    entries = validation.document_rows(parsed)
    fields = validation.detect_field(entries)
    province = parsed.select("file", F.coalesce(F.try_variant_get("doc", "$.provincia", "string"), F.lit("")).alias("provincia"))
    rows = entries.join(fields, "file").join(province, "file").select(
        "file", "i", "provincia", "phase", "field",
        F.try_variant_get("row", "$.numero_ordine", "string").try_cast("long").alias("numero_ordine"),
        F.coalesce(F.try_variant_get("row", "$.comune", "string"), F.lit("")).alias("comune"),
        validation.field_value("row", F.col("field")).alias("ind_workers_1927"),
        modern_province(F.col("provincia")).alias("modern"),
    ).withColumn("norm", accent_name(F.col("comune")))
    known = panel.select("province").where("province is not null").distinct().withColumnRenamed("province", "modern")
    rows = rows.join(known.withColumn("_k", F.lit(True)), "modern", "left").withColumn("row_id", F.struct("file", "i"))
    asked = rows.select("row_id", F.when(F.col("_k"), F.col("modern")).alias("province"), "norm")
    links = matching.link_names(asked, panel.select("idx", "province", "norm"))
    found = rows.join(links, "row_id").join(panel.select(F.col("idx").alias("panel_idx"), F.col("comune_matchable_50").alias("csv_match_name"), F.col("ind_workers_1927").alias("csv_value")), "panel_idx", "left")
    found = validation.with_value_status(found, "ind_workers_1927", "csv_value").withColumn("match_status", F.concat_ws(":", "name_status", "value_status"))
    linked = cut(found.select("file", "i", "provincia", "numero_ordine", "comune", "ind_workers_1927", "phase", "csv_match_name", "csv_value", "name_status", "value_status", "match_status", "exact_equal"))
    rates = validation.match_rates(linked, "file")
    problems = readers.document_problems(parsed)
    gate = validation.review_gate(rates)
    manifest = validation.review_manifest(linked, gate, "file", ["comune", "ind_workers_1927", "csv_match_name", "csv_value", "match_status"], (F.col("value_status") == "mismatch") | (F.col("name_status") == "no_ref"), "i")
    return {"linked": linked, "rates": rates, "problems": problems, "review": manifest}


def correct_and_fill(linked: DataFrame, fixes: DataFrame, panel: DataFrame) -> dict[str, DataFrame]:
    """Entry 2, apply and backfill: corrected rows with fresh status, and the panel with its gaps filled by name."""
    keyed = linked.withColumn("row_id", F.struct("file", "i"))
    rows = keyed.select("row_id", "file", F.col("comune").alias("name"), F.col("ind_workers_1927").alias("value"), modern_province(F.col("provincia")).alias("modern"))
    fixed = cut(corrections.apply_corrections(rows, fixes))
    known = panel.select("province").where("province is not null").distinct().select(F.col("province").alias("modern"), F.lit(True).alias("_k"))
    asked = fixed.join(known, "modern", "left").select("row_id", F.when(F.col("_k"), F.col("modern")).alias("province"), accent_name(F.col("name")).alias("norm"))
    links = matching.link_names(asked, panel.select("idx", "province", "norm"))
    fresh = fixed.join(links, "row_id").join(panel.select(F.col("idx").alias("panel_idx"), F.col("comune_matchable_50").alias("csv_match_name"), F.col("ind_workers_1927").alias("csv_value")), "panel_idx", "left")
    fresh = validation.with_value_status(fresh, "value", "csv_value").withColumn("match_status", F.concat_ws(":", "name_status", "value_status"))
    old = keyed.drop("comune", "ind_workers_1927").join(fixed.select("row_id", F.col("name").alias("comune"), F.col("value").alias("ind_workers_1927"), "value_fixed", "name_fixed"), "row_id")
    corrected = corrections.refresh_status(old, fresh.select("row_id", "match_status", "csv_match_name", "csv_value"), "row_id", ["csv_match_name", "csv_value"])
    corrected = cut(corrected)
    fills = corrections.usable_fills(corrected, "ind_workers_1927", "csv_match_name", "row_id")
    return {"corrected": corrected, "panel": corrections.backfill(panel, fills, "ind_workers_1927"), "chains": corrections.rename_chains(fixes)}


def link_population(pages: DataFrame, panel: DataFrame) -> dict[str, DataFrame]:
    """Entry 4: municipalities of OCR pages linked to the panel, both sides' leftovers, and the check of the three measures."""
    rows = ocr.parse_region_pages(pages).withColumn("norm", loose_name(F.col("comune_raw"))).withColumn("row_id", F.struct("region", "page", "line"))
    master = readers.panel_by_name(panel)
    links = matching.link_regions(rows.select("row_id", "region", "norm"), panel.select("idx", "region", loose_name(F.col("comune_matchable_50")).alias("norm")), dimensions.REGION_PROVINCES)
    linked = rows.join(links.select("row_id", "match_type", F.col("name").alias("comune_matched"), F.col("score").alias("match_score")), "row_id")
    measures = ("popres_1921_tot", "popres_1921_f", "analfabeti_1921")
    sides = linked.join(master.select(F.col("loose").alias("comune_matched"), *[F.col(c).cast("long").alias(f"csv_{c}") for c in measures]), "comune_matched")
    checks = validation.crosscheck(sides, ["comune_raw", "comune_matched"], [(c, f"csv_{c}") for c in measures])
    left = matching.reconcile(linked.select(F.col("comune_matched").alias("loose")), master, "loose")
    return {"linked": linked, "unmatched_panel": left.where("side = 'right_only'"), "checks": checks}


def validate_documents(texts: DataFrame) -> dict[str, DataFrame]:
    """Entry 3's data logic: schema errors, sequence warnings, totals and a verdict for each file."""
    parsed = validation.parse_documents(texts)
    live = parsed.where("not skipped")
    entries = validation.document_rows(live)
    number = lambda f: F.try_variant_get("row", f"$.{f}", "string").try_cast("long")
    numbers = list(dict.fromkeys([*validation.NUMBERS, *validation.NEW_FIELDS, *validation.OLD_FIELDS]))
    rows = entries.select("file", "i", *[number(f).alias(f) for f in numbers])
    # Of each document, the usual totals and those that its first row's schema has.
    schemas = entries.groupBy("file").agg(F.min_by("keys", "i").alias("first")).select("file", F.array_union(validation.schema_fields(F.col("first")), F.array(*map(F.lit, validation.TOTALS))).alias("checked"))
    sums = list(dict.fromkeys([*validation.TOTALS, *validation.NEW_FIELDS, *validation.OLD_FIELDS]))
    stated = live.join(schemas, "file", "left").select("file", *[F.when(F.array_contains("checked", f), F.try_variant_get("doc", f"$.totale_provincia.{f}", "string").try_cast("long")).alias(f) for f in sums])
    totals = validation.totals_check(rows, stated, "file", sums)
    schema = validation.schema_errors(parsed)
    breaks = validation.sequence_breaks(rows, "file", "i", "numero_ordine")
    errors = schema.select("file").unionAll(totals.select("file"))
    return {"schema": schema, "totals": totals, "sequence": breaks, "verdicts": validation.verdicts(parsed, errors, breaks, "file", parsed.where("skipped"))}


def pipeline_status(images: DataFrame, outputs: DataFrame, records: DataFrame, preview: int = 10) -> dict[str, DataFrame]:
    """Pages, spreads done and pending (the first ``preview``), and what has been recorded."""
    from ..operators.workqueue import page_pairs

    stem = lambda c: F.regexp_replace(c, "\\.[^.]*$", "")
    spreads = page_pairs(images, "name").withColumn("spread_id", F.concat_ws("_", stem("left_page"), stem("right_page")))
    state = spreads.join(outputs.select("spread_id", F.lit(True).alias("done")).distinct(), "spread_id", "left")
    return {
        "counts": state.agg(F.count(F.lit(1)).alias("n_spreads"), F.count("done").alias("n_processed")),
        "pending": state.where("done is null").select("spread_id").orderBy("spread_id").limit(preview),
        "records": records.agg(F.count(F.lit(1)).alias("n_records"), F.count_distinct("provincia").alias("n_provinces")),
    }


def session(name: str = "tessera") -> SparkSession:
    return SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").getOrCreate()

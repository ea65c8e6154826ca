"""Validation: document schema, sequence, totals, tolerance comparison, rates, review gates, cross-checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import compare_values

#: Fields of the documents.
TOP_KEYS = ("comuni", "provincia")
ROW_KEYS = ("numero_ordine", "comune", "complesso_esercizi", "complesso_addetti", "commercio_esercizi", "commercio_addetti", "vendita_vino")
NUMBERS = ("numero_ordine", "complesso_esercizi", "complesso_addetti", "commercio_esercizi", "commercio_addetti", "vendita_vino", "vendita_liquori")
TOTALS = ("complesso_esercizi", "complesso_addetti", "commercio_esercizi", "commercio_addetti", "vendita_vino", "vendita_liquori")
NEW_FIELDS = ("commercio_addetti", "complesso_esercizi", "complesso_addetti", "vendita_vino", "vendita_liquori")
OLD_FIELDS = ("commercio_addetti", "commercio_esercizi", "industria_esercizi", "industria_addetti", "vendita_vino", "vendita_liquori")
REVIEW_BELOW = 0.90


def parse_documents(texts: DataFrame, text: str = "value") -> DataFrame:
    """Adds ``doc`` (variant, null if the text is no JSON) and ``skipped``."""
    return texts.withColumn("doc", F.try_parse_json(text)).withColumn("skipped", F.coalesce(F.try_variant_get("doc", "$._skip", "boolean"), F.lit(False)))


def is_number(kind: Column) -> Column:
    """Numbers of JSON, and booleans, which count as numbers in the rule this follows."""
    return kind.rlike("^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*|BOOLEAN)$")


def document_rows(parsed: DataFrame, key: str = "file") -> DataFrame:
    """(key, i, row, keys): each entry of ``comuni`` as a variant, with the names of its fields (present, even if null)."""
    items = F.try_variant_get("doc", "$.comuni", "array<variant>")
    each = parsed.select(key, F.posexplode(items).alias("i", "row"))
    return each.withColumn("keys", F.coalesce(F.json_object_keys(F.to_json("row")), F.array().cast("array<string>")))


def schema_errors(parsed: DataFrame, key: str = "file") -> DataFrame:
    """(key, message) of every breach of the document schema; skipped documents have none.

    Unreadable text, missing top-level keys, ``comuni`` not a list or empty; in its entries missing keys and wrong types.
    """
    live = parsed.where(~F.col("skipped"))
    top = F.coalesce(F.json_object_keys(F.to_json("doc")), F.array().cast("array<string>"))
    kind = F.coalesce(F.schema_of_variant(F.try_variant_get("doc", "$.comuni", "variant")), F.lit("VOID"))
    listed = F.try_variant_get("doc", "$.comuni", "array<variant>")
    is_list = kind.startswith("ARRAY")
    heads = F.array(
        F.when(F.col("doc").isNull(), F.lit("unreadable")),
        *[F.when(F.col("doc").isNotNull() & ~F.array_contains(top, k), F.lit(f"missing top-level key: {k}")) for k in TOP_KEYS],
        F.when(F.col("doc").isNotNull() & F.array_contains(top, "comuni") & ~is_list, F.lit("comuni is not a list")),
        F.when(F.col("doc").isNotNull() & (F.coalesce(F.size(listed), F.lit(0)) <= 0), F.lit("comuni is empty")),
    )
    above = live.select(key, F.explode(F.array_compact(heads)).alias("message"))
    rows = document_rows(live, key)
    label = F.concat(F.lit("comuni["), F.col("i").cast("string"), F.lit("] ("), F.coalesce(F.try_variant_get("row", "$.comune", "string"), F.lit("?")), F.lit("): "))
    checks = [F.when(~F.array_contains("keys", k), F.concat(label, F.lit(f"missing '{k}'"))) for k in ROW_KEYS]
    for k in NUMBERS:
        got = F.schema_of_variant(F.try_variant_get("row", f"$.{k}", "variant"))
        checks.append(F.when(got.isNotNull() & (got != "VOID") & ~is_number(got), F.concat(label, F.lit(f"'{k}' should be int|null"))))
    return above.unionByName(rows.select(key, F.explode(F.array_compact(F.array(*checks))).alias("message")))


def sequence_breaks(rows: DataFrame, group: str, order: str, number: str) -> DataFrame:
    """Rows whose number is not the last one before it (of those not null; 0 at first) plus one, with ``expected``."""
    before = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    expected = F.coalesce(F.last(number, ignorenulls=True).over(before), F.lit(0)) + 1
    return rows.withColumn("expected", expected).where(F.col(number).isNotNull() & (F.col(number) != F.col("expected")))


def totals_check(rows: DataFrame, stated: DataFrame, key: str, fields: list[str], reverse: bool = False) -> DataFrame:
    """(key, field, stated, computed, diff) where a stated total is not the sum of its rows (nulls as 0).

    diff is stated - computed, or with ``reverse`` computed - stated; null stated totals, and keys without rows, are not checked.
    """
    long = lambda df, name: df.select(key, F.stack(F.lit(len(fields)), *[x for f in fields for x in (F.lit(f), F.col(f))]).alias("field", name))
    summed = rows.groupBy(key).agg(*[F.coalesce(F.sum(f), F.lit(0)).alias(f) for f in fields])
    both = long(stated, "stated").where("stated is not null").join(long(summed, "computed"), [key, "field"])
    diff = F.col("computed") - F.col("stated") if reverse else F.col("stated") - F.col("computed")
    return both.where("stated <> computed").select(key, "field", "stated", "computed", diff.alias("diff"))


def verdicts(keys: DataFrame, errors: DataFrame, warnings: DataFrame, key: str = "file", skipped: DataFrame | None = None) -> DataFrame:
    """Each key's n_errors, n_warnings and result: PASS, PASS (with n warnings), FAIL or SKIP."""
    e = errors.groupBy(key).agg(F.count(F.lit(1)).alias("n_errors"))
    w = warnings.groupBy(key).agg(F.count(F.lit(1)).alias("n_warnings"))
    found = keys.select(key).distinct().join(e, key, "left").join(w, key, "left").na.fill(0, ["n_errors", "n_warnings"])
    found = found.join(skipped.select(key, F.lit(True).alias("_s")).distinct(), key, "left") if skipped is not None else found.withColumn("_s", F.lit(None).cast("boolean"))
    result = F.when(F.col("_s"), "SKIP").when(F.col("n_errors") > 0, "FAIL").when(F.col("n_warnings") > 0, F.format_string("PASS (with %d warnings)", "n_warnings")).otherwise("PASS")
    return found.select(key, "n_errors", "n_warnings", result.alias("result"))


def detect_field(rows: DataFrame, key: str = "file") -> DataFrame:
    """(key, phase, field): where a document of (key, i, row, keys) rows keeps the number of workers.

    NEW if its first row has the key ``complesso_addetti`` (even null); else by which legacy field is null throughout.
    """
    void = lambda f: F.bool_and(F.try_variant_get("row", f"$.{f}", "string").isNull())
    flags = rows.groupBy(key).agg(F.min_by("keys", "i").alias("first"), void("commercio_esercizi").alias("c"), void("industria_addetti").alias("b"), void("vendita_liquori").alias("a"))
    new = F.array_contains("first", "complesso_addetti")
    phase = F.when(new, "NEW").when(F.col("c"), "LEGACY_C").when(F.col("b"), "LEGACY_B").when(F.col("a"), "LEGACY_A").otherwise("LEGACY_UNK")
    field = F.when(new, "complesso_addetti").when(F.col("c"), "industria_addetti").otherwise("industria_esercizi")
    return flags.select(key, phase.alias("phase"), field.alias("field"))


def field_value(row: str, field: Column, choices: tuple = NEW_FIELDS + OLD_FIELDS) -> Column:
    """The field that ``field`` names, as a whole number, null if it is none."""
    out = F.lit(None).cast("double")
    for name in dict.fromkeys(choices):
        out = F.when(field == name, F.try_variant_get(row, f"$.{name}", "string").try_cast("double")).otherwise(out)
    return out.cast("long")


def schema_fields(keys: Column) -> Column:
    """The totals to check of a document whose first row has these keys."""
    return F.when(F.array_contains(keys, "complesso_esercizi"), F.array(*map(F.lit, NEW_FIELDS))).otherwise(F.array(*map(F.lit, OLD_FIELDS)))


def all_fields(row: str = "row") -> Column:
    """The fields of new and of legacy documents in one struct of whole numbers, null where a document lacks one."""
    return F.struct(*[F.try_variant_get(row, f"$.{f}", "string").try_cast("double").cast("long").alias(f) for f in dict.fromkeys(NEW_FIELDS + OLD_FIELDS)])


def field_accuracy(links: DataFrame, checks: DataFrame, unmatched_left: DataFrame, unmatched_right: DataFrame, match_type: str = "match_type", equal: str = "equal") -> DataFrame:
    """One row with n_exact, n_fuzzy, n_unmatched_left, n_unmatched_right, total_checks, total_correct and accuracy (percent; null without checks).

    ``checks`` has a row for each field of a link that could be compared; a null ``equal`` counts as not equal.
    """
    kinds = links.agg(F.count_if(F.col(match_type) == "exact").alias("n_exact"), F.count_if(F.col(match_type) == "fuzzy").alias("n_fuzzy"))
    compared = checks.agg(F.count(F.lit(1)).alias("total_checks"), F.count_if(F.col(equal)).alias("total_correct"))
    sides = [side.agg(F.count(F.lit(1)).alias(name)) for side, name in ((unmatched_left, "n_unmatched_left"), (unmatched_right, "n_unmatched_right"))]
    out = kinds
    for one_row in [*sides, compared]:  # one row each
        out = out.crossJoin(one_row)
    return out.withColumn("accuracy", F.round(100 * F.try_divide("total_correct", "total_checks"), 1))


def with_value_status(rows: DataFrame, extracted: str, reference: str, tolerance: float = 0.10) -> DataFrame:
    """N9 as ``value_status``, and ``exact_equal``."""
    return rows.withColumn("value_status", compare_values(F.col(extracted), F.col(reference), tolerance)).withColumn("exact_equal", F.coalesce(F.col(extracted) == F.col(reference), F.lit(False)))


def match_rates(rows: DataFrame, key: str, status: str = "value_status") -> DataFrame:
    """A10: (key, total, comparable, matched, match_rate): the rate is 1 where nothing can be compared."""
    s = F.col(status)
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("total"), F.count_if(s.isin("match", "mismatch")).alias("comparable"), F.count_if(s == "match").alias("matched"))
    return counted.withColumn("match_rate", F.round(F.coalesce(F.try_divide("matched", "comparable"), F.lit(1.0)), 4))


def review_gate(rates: DataFrame, below: float = REVIEW_BELOW, error: str | None = None) -> DataFrame:
    """What needs review; order by error first, then the rate, at the sink."""
    poor = F.col("match_rate") < below
    return rates.where(F.col(error).isNotNull() | poor if error else poor)


def review_manifest(rows: DataFrame, gate: DataFrame, key: str, item: list[str], flagged: Column, order: str, top: int | None = None) -> DataFrame:
    """Each gated key with its flagged rows as an array (its first ``top`` and how many more)."""
    fields = [order, *[c for c in item if c != order]]
    found = rows.where(flagged)
    if top is not None:
        ranked = found.withColumn("_place", F.row_number().over(Window.partitionBy(key).orderBy(*fields)))
        counts = found.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        found = ranked.where(F.col("_place") <= top)
    held = found.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("mismatches"))
    out = gate.join(held, key, "left").withColumn("mismatches", F.coalesce("mismatches", F.array().cast(held.schema["mismatches"].dataType)))
    if top is None:
        return out
    return out.join(counts, key, "left").withColumn("n_more", F.greatest(F.coalesce("_n", F.lit(0)).cast("int") - top, F.lit(0))).select(*out.columns, "n_more")


def status_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows by status and their share in hundredths."""
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return counted.crossJoin(F.broadcast(total)).select(*columns, "n", F.round(100.0 * F.col("n") / F.col("total"), 1).alias("percent"))  # one row of totals


def compare_tally(rows: DataFrame) -> DataFrame:
    """One row of matched, mismatched, csv_empty (with extracted_null), no_ref and accuracy in hundredths; guards empty input."""
    known = F.col("name_status") != "no_ref"
    s = F.col("value_status")
    tally = rows.agg(F.count_if(known & (s == "match")).alias("matched"), F.count_if(known & (s == "mismatch")).alias("mismatched"), F.count_if(known & s.isin("csv_empty", "extracted_null")).alias("csv_empty"), F.count_if(~known).alias("no_ref"))
    return tally.withColumn("accuracy", F.round(F.coalesce(F.try_divide(100.0 * F.col("matched"), F.col("matched") + F.col("mismatched")), F.lit(0.0)), 1))


def crosscheck(rows: DataFrame, key: list[str], fields: list[tuple[str, str]]) -> DataFrame:
    """(key..., field, left, right, same) of each measure that both sides have; ``fields`` pairs their column names."""
    stacked = F.stack(F.lit(len(fields)), *[x for a, b in fields for x in (F.lit(a), F.col(a), F.col(b))])
    return rows.select(*key, stacked.alias("field", "left", "right")).where("left is not null and right is not null").withColumn("same", F.col("left") == F.col("right"))

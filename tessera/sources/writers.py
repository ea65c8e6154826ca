"""Writers: each writes a new version of its output; nothing is overwritten in place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CROSSWALK = ("codistat_1950", "name_1950", "province_1950", "csv_name_match", "status", "discard_reason", "mapping_1921", "mapping_1927", "mapping_1929", "mapping_type", "n_constituents_1921", "n_constituents_1927", "n_constituents_1929", "territory_transfer_flag")
LEDGER = ("csv_name", "popres_1921_tot", "popres_1921_f", "analfabeti_1921", "status", "note")


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, mode: str = "errorifexists") -> None:
    """K1, K3, K4: columns in a fixed order, with a header; nulls as empty fields."""
    (df.select(*columns) if columns else df).write.mode(mode).option("emptyValue", "").csv(path, header=True)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """K4, K7: nested records, one a line."""
    df.write.mode(mode).json(path)


def with_metadata(df: DataFrame, left: str, right: str, spread: str) -> DataFrame:
    """K7: adds ``_metadata_record`` (left_page, right_page, spread_id, status)."""
    return df.withColumn("_metadata_record", F.struct(F.col(left).alias("left_page"), F.col(right).alias("right_page"), F.col(spread).alias("spread_id"), F.lit("success").alias("status")))


def append_ledger(df: DataFrame, path: str) -> None:
    """Append; a second record of a page is a second row."""
    df.write.mode("append").parquet(path)


def update_column(table: DataFrame, path: str, dry_run: bool = False) -> int:
    """K5, K6: write the filled table as a new version, or with ``dry_run`` only count what would be filled."""
    filled = table.where("filled").count()
    if not dry_run:
        write_csv(table.drop("filled", "norm"), path)
    return filled


def population_rows(linked: DataFrame) -> DataFrame:
    """K8: scores with three decimals, nulls as empty texts."""
    out = linked.withColumn("match_score", F.format_string("%.3f", "match_score"))
    return out.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("comune_raw", "comune_matched", "match_type", "match_score", "region", "circondario", "popres_1921_tot", "popres_1921_f", "analfabeti_1921")])


def validated_rows(ledger: DataFrame) -> DataFrame:
    """The ledger by name, absent values as empty texts."""
    return ledger.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in LEDGER]).orderBy("csv_name")


def match_report(linked: DataFrame, unmatched: DataFrame, checks: DataFrame) -> dict[str, DataFrame]:
    """K9: fuzzy links from the poorest on, what stayed unmatched, and differing values with signed differences."""
    return {
        "fuzzy": linked.where("match_type = 'fuzzy'").orderBy("match_score"),
        "unmatched": unmatched,
        "mismatches": checks.where("not same").withColumn("diff", F.format_string("%+d", F.col("left") - F.col("right"))),
    }


def merge_documents(rows: DataFrame) -> DataFrame:
    """One row of records and distinct provinces of the union of all documents' rows."""
    return rows.agg(F.count(F.lit(1)).alias("n_records"), F.count_distinct("provincia").alias("n_provinces"))


def render_summary(classified: DataFrame, forward: DataFrame) -> str:
    """K2: the text summary of a crosswalk, from aggregates of a few rows."""
    from ..operators.lineage import method_counts, reason_histogram

    one = classified.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "USABLE").alias("usable"), F.count_if(F.col("territory_transfer_flag")).alias("flags")).first()
    share = lambda k: f"{100 * k / one['n']:.1f}%" if one["n"] else "-"
    lines = [f"Total: {one['n']}", f"USABLE: {one['usable']} ({share(one['usable'])})", f"DISCARD: {one['n'] - one['usable']} ({share(one['n'] - one['usable'])})", "", "Discard reasons:"]
    lines += [f"  {r['reason']}: {r['n']}" for r in reason_histogram(classified).orderBy(F.desc("n"), "reason").collect()]
    lines += ["", "Mapping types:"] + [f"  {r['mapping_type']}: {r['n']}" for r in classified.groupBy("mapping_type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n")).collect()]
    lines += ["", f"Territory transfer flags: {one['flags']}", "", "Forward methods:"]
    lines += [f"  {r['label']} {r['method']}: {r['n']}" for r in method_counts(forward).orderBy("label", "method").collect()]
    return "\n".join(lines) + "\n"

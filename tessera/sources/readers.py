"""Readers: delimited tables with declared types, JSON documents, listings, ledgers.

Every reader that feeds an order-dependent rule numbers its rows in file order (``idx``), so that no later step depends on how rows arrive.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import accent_name, live_end, loose_name, pad_code, zero_fill

REGISTRY = ("CODISTAT", "CODCATASTALE", "DENOMTRASLITTERATA", "SIGLAPROVINCIA", "DATAISTITUZIONE", "DATACESSAZIONE")
PANEL = T.StructType([T.StructField(n, T.StringType()) for n in ("comune_matchable_50", "region", "province")] + [T.StructField(n, T.DoubleType()) for n in ("popres_1921_tot", "popres_1921_f", "analfabeti_1921", "ind_workers_1927", "agri_workers_1929")])
LEDGER = T.StructType([T.StructField("csv_name", T.StringType())] + [T.StructField(n, T.LongType()) for n in ("popres_1921_tot", "popres_1921_f", "analfabeti_1921")] + [T.StructField(n, T.StringType()) for n in ("status", "note")])
LINEAGE = {
    "comuni": "sistat_id long, last_istat_cod string",
    "event_extinction": "sistat_id long, event_to_istat_cod string",
    "event_creation": "sistat_id long, event_from_istat_cod string",
    "comuni_variations": "sistat_id long, event_num long, event_type string, event_date string",
    "event_territory_acquisition": "event_num long, event_from_istat_cod string",
    "event_territory_cession": "event_num long, event_to_istat_cod string",
}


def with_idx(df: DataFrame) -> DataFrame:
    """Number rows by file, then place in the file: rising with both, not gapless."""
    return df.withColumn("idx", F.monotonically_increasing_id())


def _named(spark: SparkSession, path: str, schema: str, sep: str) -> DataFrame:
    """Columns of a delimited file by the names in its header, cast to ``schema``; columns it lacks are null."""
    raw = spark.read.option("sep", sep).csv(path, header=True)
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return raw.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) if f.name in raw.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted.fields])


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Code, key, name, sigla, start, end, idx; all text read as text (``NA`` stays), trimmed, codes padded, bad dates null."""
    raw = _named(spark, path, ", ".join(f"{c} string" for c in REGISTRY), ",")
    text = lambda c: F.coalesce(F.trim(c), F.lit(""))
    day = lambda c: F.coalesce(F.try_to_date(F.col(c), "yyyy-MM-dd"), F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd"))
    return with_idx(raw.select(zero_fill(F.col("CODISTAT")).alias("code"), text("CODCATASTALE").alias("key"), text("DENOMTRASLITTERATA").alias("name"), text("SIGLAPROVINCIA").alias("sigla"), day("DATAISTITUZIONE").alias("start"), live_end(day("DATACESSAZIONE")).alias("end")))


def read_lineage(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The six tab-separated tables by name, codes padded, dates parsed, rows numbered."""
    out = {}
    for name, schema in LINEAGE.items():
        table = with_idx(_named(spark, f"{folder}/{name}.tab", schema, "\t"))
        for c in table.columns:
            if c.endswith("_cod"):
                table = table.withColumn(c, pad_code(F.col(c)))
            elif c == "event_date":
                table = table.withColumn(c, F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd"))
        out[name] = table
    return out


def id_maps(comuni: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Id to code and code to id, the last row of each counting."""
    return comuni.groupBy("sistat_id").agg(F.max_by("last_istat_cod", "idx").alias("code")), comuni.groupBy(F.col("last_istat_cod").alias("code")).agg(F.max_by("sistat_id", "idx").alias("sistat_id"))


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    """S3: the typed panel with ``norm`` (accents as quotes) and idx."""
    return with_idx(_named(spark, path, PANEL, ",")).withColumn("norm", accent_name(F.col("comune_matchable_50")))


def panel_by_name(panel: DataFrame) -> DataFrame:
    """One row for each loose name, the last of the file."""
    return panel.groupBy(loose_name(F.col("comune_matchable_50")).alias("loose")).agg(F.max_by(F.struct(*panel.columns), "idx").alias("r")).select("loose", "r.*")


def read_documents(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """File (name), stem and value (whole text) of each JSON file; parse with :func:`tessera.operators.validation.parse_documents`."""
    texts = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True).select("value", F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"))
    return texts.select("file", F.regexp_replace("file", "\\.[^.]*$", "").alias("stem"), "value")


def document_problems(parsed: DataFrame) -> DataFrame:
    """(file, error) of files that do not parse or have no rows; skip markers have none and are listed apart."""
    n = F.coalesce(F.size(F.try_variant_get("doc", "$.comuni", "array<variant>")), F.lit(0))
    return parsed.select("file", F.when(F.col("doc").isNull(), "unreadable").when(n <= 0, "no comuni").alias("error")).where("error is not null")


def read_ocr_cache(spark: SparkSession, path: str) -> DataFrame:
    """(region, page, markdown) of cached OCR results, the region being the file's stem."""
    pages = F.from_json("value", "pages array<struct<markdown:string>>")["pages"]
    return read_documents(spark, path).select(F.col("stem").alias("region"), F.posexplode(pages).alias("page", "p")).select("region", "page", F.col("p.markdown").alias("markdown"))


def ocr_cost(pages: DataFrame, cached: DataFrame, each: float = 0.002) -> DataFrame:
    """One row of all pages, their cost, and the pages still to send; cached ones count in the cost too."""
    known = cached.select("region").distinct().withColumn("_c", F.lit(True))
    return pages.join(known, "region", "left").agg(F.count(F.lit(1)).alias("n_pages"), F.count_if(F.col("_c").isNull()).alias("n_to_send")).withColumn("cost", F.round(F.col("n_pages") * each, 6))


def list_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(path, name, stem, id) of matching files, without their contents."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path")
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name")).withColumn("stem", F.regexp_replace("name", "\\.[^.]*$", "")).withColumn("id", F.col("stem"))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType = LEDGER) -> DataFrame:
    """A Parquet ledger, or an empty one where there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], schema)


def read_validation_lookup(texts: DataFrame) -> DataFrame:
    """(key, search_name, measures) of a {key: [records]} document."""
    kind = "map<string,array<struct<search_name:string,popres_1921_tot:long,popres_1921_f:long,analfabeti_1921:long>>>"
    return texts.select(F.explode(F.from_json("value", kind)).alias("key", "rows")).select("key", F.inline("rows"))


def last_rows(df: DataFrame, key: str, order: str = "idx") -> DataFrame:
    """The last row of each key."""
    return df.groupBy(key).agg(F.max_by(F.struct(*df.columns), order).alias("r")).select("r.*")


def first_rows(df: DataFrame, key: str, order: str = "idx") -> DataFrame:
    """The first row of each key."""
    return df.groupBy(key).agg(F.min_by(F.struct(*df.columns), order).alias("r")).select("r.*")



"""Corpus pipeline: quality rules, one document of each group of near copies, secrets masked, sources mixed, packed.

Each stage takes (spark, docs, sf_dir) and works on all rows of its predecessor.  All but the last return the columns of
``documents``.  The mix takes effect as the order of the rows in the files of its stage, which the packing stage reads back
(file name, row number) and follows in the numbers of its sequences; rows that carry no place in a file are written first.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import jaccard, mixing, packing, quality, secret_scan
from tessera.llm.common import materialize, read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the Jaccard join: that with the least id."""
    return jaccard.keep_one_of_each(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return secret_scan.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, sorted into the mix of sources."""
    return mixing.mixed_order(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents; sequences of one length are numbered in the order of the mix."""
    place = [F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    try:
        placed = docs.select("doc_id", "text", *place)
    except AnalysisException:  # not read from files: write the rows as they come
        placed = materialize(docs.select("doc_id", "text"), "mix").select("doc_id", "text", *place)
    return packing.pack_documents(placed, keep_ids=False, rank=("_file", "_row"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secret_scans),
    ("mixing sources", mix_sources),
    ("packing", pack),
]

#: Token ids have no SQL form; tests hold the pipeline against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

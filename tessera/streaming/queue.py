"""The work queue as a stream: new document files are claimed once, validated and appended, with a checkpoint for locks.

The file source hands each file to one micro-batch, and the checkpoint remembers it over restarts, so there are no lock files and
no stale locks.  ``max_files`` bounds a batch.  A log that speaks of a rate limit stops the stream before the batch is marked as done, so
its files come again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.names import rate_limited
from ..plans.workflows import validate_documents


class RateLimited(RuntimeError):
    """A batch's text speaks of a rate limit."""


def document_stream(spark: SparkSession, folder: str, max_files: int = 3, glob: str = "*.json") -> DataFrame:
    texts = spark.readStream.format("text").schema("value string").option("wholetext", True).option("pathGlobFilter", glob).option("maxFilesPerTrigger", max_files).load(folder)
    return texts.select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), "value")


def run_queue(spark: SparkSession, folder: str, out: str, checkpoint: str, max_files: int = 3, logs: str | None = None, dry_run: bool = False) -> StreamingQuery:
    """Q1 to Q6: validate all files present, a batch at a time, then stop; verdicts are appended as Parquet with their batch.

    ``logs``: a folder of text logs that is looked through before every batch.  ``dry_run`` computes and writes nothing.
    """

    def handle(batch: DataFrame, number: int) -> None:
        if logs is not None and not batch.sparkSession.read.text(logs).where(rate_limited(F.col("value"))).isEmpty():
            raise RateLimited(f"batch {number} is left for the next run")
        verdicts = validate_documents(batch)["verdicts"].withColumn("batch", F.lit(number))
        if dry_run:
            verdicts.count()
        else:
            verdicts.write.mode("append").parquet(out)

    return document_stream(spark, folder, max_files).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

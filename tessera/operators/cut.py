"""Cutting a plan where its result is used several times, and the folder for files that a query writes and reads again."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder, which all executors share; cached where no folder is set."""
    spark = df.sparkSession
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder and context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(folder)
    return df.checkpoint() if context._jsc.sc().getCheckpointDir().isDefined() else df.cache()


def scratch(spark: SparkSession) -> str:
    """A new path in ``spark.checkpoint.dir``, deleted when the process ends; without that setting, a folder of this machine, and an error on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext._jsc.sc().isLocal():
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="tessera-files-")
    path = f"{folder.rstrip('/')}/tessera-files-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may be gone first
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import contextlib
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of all word rules: the blank and the five control characters from tab to carriage return.
SPACE_CLASS = "[\\x20\\x09-\\x0D]"
WORD_CLASS = "[^\\x20\\x09-\\x0D]+"

_written: list[tuple[SparkSession, str]] = []


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder; any path that Spark's readers open will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir``.

    Where that is unset, a session on one machine gets a folder of its own; on a cluster it is an error, since executors share no local folder.
    """
    context = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None)
    if not known:
        held = context._jsc.sc().getCheckpointDir()
        known = held.get() if held.isDefined() else None
    if not known:
        if not context._jsc.sc().isLocal():
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        known = tempfile.mkdtemp(prefix="tessera-shared-")
        context.setCheckpointDir(known)
    return known.rstrip("/")


def _drop(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _drop_written() -> None:
    for spark, path in _written:
        with contextlib.suppress(Exception):
            _drop(spark, path)


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: lineage ends there, on storage all executors see.

    The folder goes with :func:`release`, or when the Python process ends.  Collecting the driver's garbage then lets Spark's cleaner drop
    the shuffle files of the plan that ended, so a chain of such tables holds one step's shuffles at a time.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tessera-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    made = spark.read.schema(df.schema).parquet(path)
    made._tessera_path = path
    return made


def release(*tables: DataFrame | None) -> None:
    """Delete materialized tables whose last reader has been written."""
    for table in tables:
        path = getattr(table, "_tessera_path", None)
        if path is not None:
            _drop(table.sparkSession, path)
            _written.remove((table.sparkSession, path))
            table._tessera_path = None


#: Rows of an Arrow batch, the same for all operators: the setting is the session's and read when a plan runs.
BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches between the JVM and Python by rows and, where Spark has the setting, by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    with contextlib.suppress(Exception):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20)


def free_names(taken: list[str], *wanted: str) -> list[str]:
    """``wanted`` with underscores added until no name clashes with one of ``taken``, in any case."""
    used = {c.lower() for c in taken}
    out = []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, group: str, spread: str, order: list[str], name: str) -> DataFrame:
    """Number the rows of each group gaplessly from 0 without gathering a group in one task.

    ``spread`` names a column with a bounded number of values that cuts each group into sub-groups; rows are numbered
    by ``spread`` first, then by ``order``.  Only the (group, spread) counts are brought together, so a group with a
    third of all rows is sorted by as many tasks as ``spread`` has values.  Null group values form a group of their own.
    ``df`` moves once: the counts are joined on the keys by which the window has dealt it.
    """
    from pyspark.sql import Window

    key, n, before, row = free_names(df.columns, "_key", "_n", "_before", "_row")
    keyed = df.withColumn(key, F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("null")))
    counts = keyed.groupBy(key, spread).agg(F.count(F.lit(1)).alias(n))
    earlier = Window.partitionBy(key).orderBy(spread).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(key, spread, F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(before))
    inside = Window.partitionBy(key, spread).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    placed = keyed.withColumn(row, F.row_number().over(inside)).join(counts, [key, spread])
    return placed.select(*df.columns, (F.col(before) + F.col(row) - 1).cast("long").alias(name))

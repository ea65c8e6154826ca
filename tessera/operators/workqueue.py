"""Work queues as relations: state, what is left, batches, page pairs, the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.names import page_key_parts

LEDGER_STATES = ("CONFIRMED", "CORRECTED", "NOT_FOUND")


def pair_inventory(spark: SparkSession, total: int = 188, form: str = "pair_%04d") -> DataFrame:
    """Ids of all items."""
    return spark.range(total).select(F.format_string(form, "id").alias("id"))


def done_ids(outputs: DataFrame, locks: DataFrame) -> DataFrame:
    """Distinct ids of outputs and locks."""
    return outputs.select("id").union(locks.select("id")).distinct()


def remaining(inventory: DataFrame, done: DataFrame) -> DataFrame:
    """Ids of the inventory that are not done; order at the sink."""
    return inventory.select("id").join(done.select("id"), "id", "left_anti")


def queue_status(inventory: DataFrame, outputs: DataFrame, locks: DataFrame) -> DataFrame:
    """One row of total, completed, in_progress, skipped, remaining and next.

    ``outputs`` has id and skipped.  Completed is all done less skipped and in progress, and is not held to the inventory.
    """
    out = outputs.groupBy("id").agg(F.bool_or(F.coalesce("skipped", F.lit(False))).alias("skipped"), F.lit(True).alias("has_out"))
    state = inventory.select("id", F.lit(True).alias("listed")).distinct().join(out, "id", "full_outer").join(locks.select("id", F.lit(True).alias("locked")).distinct(), "id", "full_outer")
    done = F.col("has_out").isNotNull() | F.col("locked").isNotNull()
    waiting = F.col("listed").isNotNull() & ~done
    busy = F.col("locked").isNotNull() & F.col("has_out").isNull()
    skipped = F.coalesce("skipped", F.lit(False))
    return state.agg(
        F.count("listed").alias("total"),
        (F.count_if(done) - F.count_if(skipped) - F.count_if(busy)).alias("completed"),
        F.count_if(busy).alias("in_progress"),
        F.count_if(skipped).alias("skipped"),
        F.count_if(waiting).alias("remaining"),
        F.min(F.when(waiting, F.col("id"))).alias("next"),
    )


def next_batch(keys: DataFrame, done: DataFrame, size: int = 3, region: str | None = None) -> DataFrame:
    """The first ``size`` keys that are not done, in text order, of one region if asked for."""
    left = keys.select("key").join(done.select("key"), "key", "left_anti")
    if region is not None:
        left = left.where(page_key_parts(F.col("key"))[0] == region)
    return left.orderBy("key").limit(size)


def remaining_by_region(keys: DataFrame, done: DataFrame) -> DataFrame:
    """A18, J26."""
    return keys.select("key").join(done.select("key"), "key", "left_anti").groupBy(page_key_parts(F.col("key"))[0].alias("region")).agg(F.count(F.lit(1)).alias("n_pages"))


def page_pairs(pages: DataFrame, name: str = "name", group: str | None = None) -> DataFrame:
    """(left_page, right_page): consecutive pages in name order, an odd last one dropped.

    With ``group`` pages pair within it.  Without, the places in the whole order come from ranges cut at a bounded sample of names: each range numbers its
    own rows and adds the rows before it, of which there is a count for each range, so no task holds all rows.
    """
    if group:
        ranked = pages.select(group, name, (F.row_number().over(Window.partitionBy(group).orderBy(name)) - 1).alias("_k"))
        keys = [group]
    else:
        parts = max(2, int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        total = pages.count()
        thin = max(1, total // (50 * parts))
        sample = sorted(r[0] for r in pages.select(name).where(F.pmod(F.xxhash64(name), F.lit(thin)) == 0).distinct().limit(400 * parts).collect())
        cuts = sample[:: max(1, len(sample) // parts)][1:]
        bucket = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: F.col(name) >= c)) if cuts else F.lit(0)
        spread = pages.select(name, bucket.alias("_b"))
        sizes = spread.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
        before = sizes.select("_b", F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
        ranked = spread.withColumn("_i", F.row_number().over(Window.partitionBy("_b").orderBy(name)) - 1).join(F.broadcast(before), "_b").select(name, (F.col("_before") + F.col("_i")).alias("_k"))
        keys = []
    paired = ranked.groupBy(*keys, F.floor(F.col("_k") / 2).alias("spread")).agg(F.count(F.lit(1)).alias("_n"), F.min(name).alias("left_page"), F.max(name).alias("right_page"))
    return paired.where("_n = 2").drop("_n")


def pending(spreads: DataFrame, outputs: DataFrame, key: str = "spread_id") -> DataFrame:
    """P9, J25."""
    return spreads.join(outputs.select(key), key, "left_anti")


def page_range(volumes: DataFrame) -> DataFrame:
    """(volume, page) of (volume, first, last) ranges."""
    return volumes.select("volume", F.explode(F.sequence("first", "last")).alias("page"))


def ledger_report(results: DataFrame, status: str = "status") -> DataFrame:
    """One row of total and of the number and share of each state."""
    counts = results.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(status) == s).alias(s.lower()) for s in LEDGER_STATES])
    return counts.withColumns({f"{s.lower()}_percent": F.round(F.coalesce(F.try_divide(100.0 * F.col(s.lower()), F.col("total")), F.lit(0.0)), 1) for s in LEDGER_STATES})


def notes_about(notes: DataFrame, item: str, text: str = "value") -> DataFrame:
    """Lines of the notes that name an item, trimmed."""
    return notes.where(F.contains(text, F.lit(item))).select(F.trim(text).alias("line"))

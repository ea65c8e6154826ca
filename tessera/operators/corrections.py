"""Corrections, backfill of nulls, coverage, and the assembled panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import accent_name

#: Statuses whose values may fill gaps.
GOOD_STATUSES = ("exact:match", "exact:csv_empty", "fuzzy:match", "fuzzy:csv_empty")


def parse_corrections(texts: DataFrame, text: str = "value") -> DataFrame:
    """(file, name, new_value, new_name) of {file: {name: number or {corrected_name, ind_workers}}}."""
    files = texts.select(F.explode(F.from_json(text, "map<string,string>")).alias("file", "entries"))
    each = files.select("file", F.explode(F.from_json("entries", "map<string,string>")).alias("name", "raw")).withColumn("v", F.try_parse_json("raw"))
    value = F.coalesce(F.try_variant_get("v", "$.ind_workers", "double"), F.try_variant_get("v", "$", "double")).cast("long")
    return each.select("file", "name", value.alias("new_value"), F.try_variant_get("v", "$.corrected_name", "string").alias("new_name"))


def apply_corrections(rows: DataFrame, corrections: DataFrame, value: str = "value", norm=accent_name) -> DataFrame:
    """``rows`` (row_id, file, name, ``value``) with corrected values and names, and flags value_fixed and name_fixed.

    A correction goes to the rows of its file with that very name, or if there are none, to those with its normal name.  Applied in one
    pass; see :func:`rename_chains` for corrections that meet renamed rows.
    """
    c = corrections.select("file", F.col("name").alias("c_name"), "new_value", "new_name").withColumn("c_norm", norm(F.col("c_name")))
    exact = rows.select("file", F.col("name").alias("c_name")).distinct()
    by_name = c.join(exact, ["file", "c_name"], "left_semi")
    by_norm = c.join(exact, ["file", "c_name"], "left_anti").groupBy("file", "c_norm").agg(F.max_by(F.struct("new_value", "new_name"), "c_name").alias("n"))
    one = by_name.groupBy("file", "c_name").agg(F.max_by(F.struct("new_value", "new_name"), "c_name").alias("e"))
    found = rows.withColumn("c_norm", norm(F.col("name"))).join(one.withColumnRenamed("c_name", "name"), ["file", "name"], "left").join(by_norm, ["file", "c_norm"], "left").drop("c_norm")
    new_value, new_name = F.coalesce("n.new_value", "e.new_value"), F.coalesce("n.new_name", "e.new_name")
    return found.select(*[c for c in rows.columns if c not in (value, "name")], F.coalesce(new_name, F.col("name")).alias("name"), F.coalesce(new_value, F.col(value)).alias(value), new_value.isNotNull().alias("value_fixed"), new_name.isNotNull().alias("name_fixed"))


def rename_chains(corrections: DataFrame) -> DataFrame:
    """(file, name, new_name) of corrections whose new name another correction of the file asks for: their order would matter."""
    again = corrections.select("file", F.col("name").alias("new_name")).distinct()
    return corrections.where("new_name is not null and new_name <> name").join(again, ["file", "new_name"], "left_semi").select("file", "name", "new_name")


def correction_counts(before: DataFrame, after: DataFrame, status: str = "match_status") -> DataFrame:
    """(status, n_before, n_after) of each status (null is one) before and after a run of corrections."""
    sides = [side.groupBy(F.col(status).alias("status")).agg(F.count(F.lit(1)).alias(n)) for side, n in ((before, "n_before"), (after, "n_after"))]
    both = sides[0].unionByName(sides[1], allowMissingColumns=True)
    return both.groupBy("status").agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in ("n_before", "n_after")])


def refresh_status(old: DataFrame, new: DataFrame, key: str, columns: list[str], status: str = "match_status") -> DataFrame:
    """The old row, with ``columns`` and the status from the new one only where the status differs."""
    fresh = new.select(key, F.col(status).alias("_s"), *[F.col(c).alias(f"_{c}") for c in columns])
    both = old.join(fresh, key, "left")
    changed = ~F.col("_s").eqNullSafe(F.col(status)) & F.col("_s").isNotNull()
    updates = {c: F.when(changed, F.col(f"_{c}")).otherwise(F.col(c)) for c in columns}
    return both.withColumn("revalidated", changed).withColumns(updates).withColumn(status, F.when(F.col("revalidated"), F.col("_s")).otherwise(F.col(status))).drop("_s", *[f"_{c}" for c in columns])


def usable_fills(rows: DataFrame, value: str, name: str, order: str, statuses: tuple = GOOD_STATUSES, status: str = "match_status", norm: Column | None = None) -> DataFrame:
    """(norm, fill): the first value, by ``order``, of each name among rows of good status."""
    good = rows.where(F.col(status).isin(*statuses) & F.col(value).isNotNull() & F.col(name).isNotNull())
    return good.groupBy((accent_name(F.col(name)) if norm is None else norm).alias("norm")).agg(F.min_by(value, order).alias("fill"))


def backfill(table: DataFrame, fills: DataFrame, column: str, key: str = "norm", extra: list[str] = ()) -> DataFrame:
    """``table`` with nulls of ``column`` from ``fills`` by ``key`` (and ``extra`` keys), and the flag ``filled``."""
    keys = [key, *extra]
    both = table.join(fills.select(*keys, "fill"), keys, "left")
    return both.withColumn("filled", F.col(column).isNull() & F.col("fill").isNotNull()).withColumn(column, F.coalesce(F.col(column), F.col("fill").cast(table.schema[column].dataType))).drop("fill")


def fill_counts(before: DataFrame, column: str, after: DataFrame) -> DataFrame:
    """One row of n_empty, n_filled and n_left."""
    empty = before.agg(F.count_if(F.col(column).isNull()).alias("n_empty"))
    return empty.crossJoin(after.agg(F.count_if("filled").alias("n_filled"))).withColumn("n_left", F.col("n_empty") - F.col("n_filled"))  # one row each


def coverage(table: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, n_present, n_rows, percent): how much of each column is not null."""
    counted = table.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(c) for c in columns])
    long = counted.select("n_rows", F.stack(F.lit(len(columns)), *[x for c in columns for x in (F.lit(c), F.col(c))]).alias("column_name", "n_present"))
    return long.select("column_name", "n_present", "n_rows", F.round(F.coalesce(F.try_divide(100.0 * F.col("n_present"), F.col("n_rows")), F.lit(0.0)), 1).alias("percent"))


def assemble_panel(classified: DataFrame, measures: dict[str, DataFrame]) -> DataFrame:
    """Usable reference codes with, for each label, the sums of its measures over the codes that make them up.

    ``measures`` has for each label a table of code and numeric columns.
    """
    panel = classified.where("status = 'USABLE'").select("code")
    for label, table in measures.items():
        names = [c for c in table.columns if c != "code"]
        parts = classified.where("status = 'USABLE'").select("code", F.explode(F.split(f"mapping_{label}", "\\|")).alias("part")).where("part <> ''")
        summed = parts.join(table.withColumnRenamed("code", "part"), "part").groupBy("code").agg(*[F.sum(c).alias(f"{c}_{label}") for c in names])
        panel = panel.join(summed, "code", "left")
    return panel

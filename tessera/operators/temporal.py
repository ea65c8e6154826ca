"""Validity intervals: what is alive at a date, and drift from expected numbers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Census dates, the reference date and the numbers published for them.
CENSUS_DATES = {"1921": "1921-12-01", "1927": "1927-10-15", "1929": "1929-10-15"}
REFERENCE_DATE = "1950-06-15"
EXPECTED_ALIVE = {"1921": 9202, "1927": 8928, "1929": 7308, "ref": 7803}


def alive_when(start: Column, end: Column, at: Column) -> Column:
    """Closed interval; nulls are not alive."""
    return (start <= at) & (end >= at)


def alive_at(entities: DataFrame, at: str | date, code: str = "code", start: str = "start", end: str = "end") -> DataFrame:
    """The distinct codes alive at one date."""
    return entities.where(alive_when(F.col(start), F.col(end), F.lit(at).cast("date"))).select(code).distinct()


def alive_sets(entities: DataFrame, dates: dict[str, str], code: str = "code", start: str = "start", end: str = "end") -> DataFrame:
    """(label, code), distinct, for several dates at once.

    The dates are a handful of literals, so each row is tested against all of them in one pass and no join is needed.
    """
    labels = F.array(*[F.when(alive_when(F.col(start), F.col(end), F.lit(d).cast("date")), F.lit(k)) for k, d in dates.items()])
    return entities.select(F.explode(F.array_compact(labels)).alias("label"), code).distinct()


def alive_counts(alive: DataFrame) -> DataFrame:
    return alive.groupBy("label").agg(F.count(F.lit(1)).alias("n_alive"))


def alive_drift(counts: DataFrame, expected: dict[str, int]) -> DataFrame:
    """Labels whose number is not the expected one, with both; a label without entities counts 0."""
    spark = counts.sparkSession
    wanted = spark.createDataFrame([(k, int(v)) for k, v in expected.items()], "label string, expected long")
    # Both sides have a row for each label.
    return wanted.join(counts, "label", "left").select("label", "expected", F.coalesce("n_alive", F.lit(0)).cast("long").alias("actual")).where("actual <> expected")

"""Sequence similarity: the ratio of matching blocks, and a bound that needs only lengths.

Neither Spark nor DuckDB has this ratio, so it is a pandas UDF on the standard library; it is asymmetric, so callers keep the order.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def ratio_batch(first: pd.Series, second: pd.Series) -> pd.Series:
    """Ratio of ``first`` (the sequence that moves) to ``second`` (the one that is indexed); null if either is."""
    matcher, last, out = SequenceMatcher(None), None, []
    for a, b in zip(first, second, strict=True):
        if a is None or b is None:
            out.append(None)
            continue
        if b != last:
            matcher.set_seq2(b)
            last = b
        matcher.set_seq1(a)
        out.append(matcher.ratio())
    return pd.Series(out, dtype="float64")


seq_ratio = F.pandas_udf(ratio_batch, DoubleType())


def length_bound(a: Column, b: Column) -> Column:
    """The most that the ratio can be at these lengths; 1 for two empty texts."""
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * F.least(F.length(a), F.length(b)) / total)

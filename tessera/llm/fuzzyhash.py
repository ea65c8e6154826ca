"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash of the last seven bytes ends a chunk wherever it is -1 modulo the block size; each chunk gives one character of the
signature.  A fingerprint ``block:signature:coarser`` holds the signatures at a block size and at its double.  Block sizes are 3
times a power of two, the least that makes about 64 chunks, halved while the signature has fewer than 32 characters.

Likeness (0 to 1) compares signatures of equal block size: 0 if they have no common run of five characters (or of half the shorter
signature), else 1 minus the edit distance over the longer's length.

Defined results: null and empty texts are the fingerprint ``3::``; texts are used whole, as UTF-8; equal texts have equal
fingerprints and likeness 1; neighbours in the id order are found over all rows, ties by the text's CRC-32 and the text, null ids last;
a single row is its own neighbour; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, partitions, small_batches

WINDOW, LONGEST, SHORTEST, LEAST_BLOCK, COMMON = 7, 64, 32, 3, 5
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_FACTORS = [np.uint32(pow(0x9E3779B1, k + 1, 1 << 32) | 1) for k in range(WINDOW)]


def rolling(raw: np.ndarray) -> np.ndarray:
    """Hash of the up to seven bytes that end at each place."""
    wide = raw.astype(np.uint32)
    wide += np.uint32(1)
    out = wide * _FACTORS[0]
    for k in range(1, WINDOW):
        out[k:] += wide[:-k] * _FACTORS[k]
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x2C1B3C6D)
    out ^= out >> np.uint32(13)
    return out


def _letters(raw: bytes, ends: np.ndarray, most: int) -> str:
    """One letter for each chunk; after ``most - 1`` chunks all the rest is one."""
    cuts = [0, *(ends[: most - 1] + 1).tolist()]
    if cuts[-1] < len(raw):
        cuts.append(len(raw))
    return "".join(LETTERS[(zlib.crc32(raw[a:b]) * 0x9E3779B1 >> 26) & 63] for a, b in zip(cuts, cuts[1:], strict=False))


def fingerprint(text: str | None) -> str:
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return f"{LEAST_BLOCK}::"
    block = LEAST_BLOCK
    while block * LONGEST < len(raw):
        block *= 2
    rolled = rolling(np.frombuffer(raw, dtype=np.uint8))
    while True:
        ends = np.flatnonzero(rolled % np.uint32(block) == np.uint32(block - 1))
        if len(ends) + 1 >= SHORTEST or block == LEAST_BLOCK:
            break
        block //= 2
    coarse = ends[rolled[ends] % np.uint32(2 * block) == np.uint32(2 * block - 1)]
    return f"{block}:{_letters(raw, ends, LONGEST)}:{_letters(raw, coarse, SHORTEST)}"


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance, a column of the table at a time in the bits of an integer."""
    if not a or not b:
        return len(a) + len(b)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score = full, 0, len(a)
    for c in b:
        match = where.get(c, 0)
        level = (((match & up) + up) ^ up) | match | down
        plus = down | (full & ~(level | up))
        minus = up & level
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus = plus << 1 | 1
        across = match | down
        up = (minus << 1 | ~(across | plus)) & full
        down = plus & across & full
    return score


def _like(a: str, b: str) -> float:
    run = min(COMMON, (min(len(a), len(b)) + 1) // 2)
    if not run or {a[i : i + run] for i in range(len(a) - run + 1)}.isdisjoint(b[i : i + run] for i in range(len(b) - run + 1)):
        return 0.0
    return 1 - edit_distance(a, b) / max(len(a), len(b))


def likeness(one: str, two: str) -> float:
    """Likeness of two fingerprints; 0 if their block sizes are neither equal nor one the double of the other."""
    if one == two:
        return 1.0
    (b1, s1, t1), (b2, s2, t2) = one.split(":"), two.split(":")
    n1, n2 = int(b1), int(b2)
    if n1 == n2:
        return max(_like(s1, s2), _like(t1, t2))
    if n1 == 2 * n2:
        return _like(s1, t2)
    if n2 == 2 * n1:
        return _like(t1, s2)
    return 0.0


def fingerprints(docs: DataFrame, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """``docs`` with ``out_col``, the fingerprint of each text; a column of that name is replaced."""
    small_batches(docs.sparkSession)
    make = F.udf(fingerprint, "string", useArrow=True)
    return docs.withColumn(out_col, make(F.col(text_col)))


def edited(text: str, other: str) -> str:
    """``text`` with its last third (rounded down) replaced by as much of the start of ``other``."""
    cut = len(text) // 3
    return text[: len(text) - cut] + other[:cut]


_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
_EDGE = pa.schema([*_DIGEST, ("part", pa.int64()), ("first_text", pa.string()), ("last_id", pa.int64()), ("last_text", pa.string())])


def _digest_row(doc_id: int | None, text: str, mark: str, other: str, other_mark: str) -> tuple:
    new = edited(text, other)
    new_mark = fingerprint(new) if new != text else mark
    return doc_id, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), mark, new_mark, likeness(mark, new_mark), likeness(mark, other_mark)


def fingerprint_digest(docs: DataFrame) -> DataFrame:
    """Each row's fingerprint, that of its edited text and their likeness, and the likeness to the next row, by falling doc_id.

    One shuffle: rows go to range partitions in the order of the ids and each task walks its own.  A task's first and last rows
    (two texts a task) meet their neighbours in a second, small step.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.crc32(F.col("text").cast("binary"))]
    dealt = rows.repartitionByRange(max(8, 2 * partitions(spark)), *order).sortWithinPartitions(*order, "text")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        held = first = None
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                mark = fingerprint(text)
                if held is not None:
                    out.append((*_digest_row(*held, text, mark), None, None, None, None))
                else:
                    first = text
                held = doc_id, text, mark
            yield _batch(out, _EDGE)
        if held is not None:
            yield _batch([(None,) * 7 + (part, first, held[0], held[1])], _EDGE)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, part long, first_text string, last_id long, last_text string"
    walked = materialize(dealt.mapInArrow(walk, schema), "fingerprints")
    # One row for each range partition: bounded by their number.
    edges = walked.where(F.col("part").isNotNull()).select("part", "first_text", "last_id", "last_text")
    ring = Window.orderBy("part")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = edges.select("last_id", "last_text", F.coalesce(F.lead("first_text").over(ring), F.first("first_text").over(whole)).alias("next_text"))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch([_digest_row(i, a, fingerprint(a), b, fingerprint(b)) for i, a, b in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True)], _DIGEST)

    digest_schema = ", ".join(schema.split(", ")[:7])
    return walked.where(F.col("part").isNull()).select(*_DIGEST.names).unionByName(following.mapInArrow(close, digest_schema))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

"""Language identification by compression: the language whose zstandard dictionary makes a text smallest.

Each language has a raw-content dictionary made of labelled texts.  A text is cut into blocks of ``block_bytes``, so that the
dictionary stays in reach along texts of any length, and every block is compressed with every dictionary; the language with
the fewest bytes in all wins.  Both sides are lower-cased first.  Where the runner-up needs less than ``min_margin`` more, the prediction is marked as not accepted.

Learning uses a bounded sample: of each language's labelled rows, one for each of ``sample_docs`` salts (the row with the least hash among
those of that salt), whole texts, the shortest first, as long as they fit into ``dict_bytes`` in all; the shortest is always used.

Defined results: a null text or one without a letter is ``und`` with score 0; texts are used whole; a table without labelled
rows predicts ``und`` throughout; ties go to the first language in order; repeated rows give repeated results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches

UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageRules:
    """Production parameters."""

    sample_docs: int = 128
    dict_bytes: int = 110 * 1024
    block_bytes: int = 4096
    level: int = 5
    min_match: int = 4
    search_log: int = 3
    min_margin: float = 0.01


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def learn(labelled: DataFrame, rules: LanguageRules = LanguageRules(), id_col: str = "doc_id") -> dict[str, bytes]:
    """Dictionary content by language, from the ``lang`` and ``text`` of the labelled rows.

    At most ``sample_docs`` ids and sizes a language come together, by an aggregate that combines before the shuffle; then the texts that fit.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}")).select(F.col(id_col).alias("_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    keys = ["lang", "_h", "_id", "_size"]
    hashed = rows.withColumn("_h", F.xxhash64(F.col("_id").cast("string"))).withColumn("_size", F.octet_length("text"))
    sample = hashed.groupBy("lang", F.pmod("_h", F.lit(rules.sample_docs)).alias("_salt")).agg(F.min(F.struct("_h", "_id", "_size")).alias("m")).select("lang", "m.*").distinct()
    so_far = Window.partitionBy("lang").orderBy("_size", "_h", "_id").rowsBetween(Window.unboundedPreceding, 0)
    chosen = sample.withColumn("_sum", F.sum(F.col("_size") + 1).over(so_far)).withColumn("_place", F.row_number().over(so_far)).where((F.col("_sum") <= rules.dict_bytes) | (F.col("_place") == 1)).select(*[F.col(k).alias(f"{k}2") for k in keys])
    same = F.col("lang") == F.col("lang2")
    for k in keys[1:]:
        same &= F.col(k).eqNullSafe(F.col(f"{k}2"))
    texts = hashed.join(F.broadcast(chosen), same).groupBy(*keys).agg(F.min("text").alias("text"))
    held: dict[str, list[bytes]] = {}
    for row in sorted(texts.collect(), key=lambda r: (r["lang"], -r["_size"], r["_h"], str(r["_id"]))):  # short ones last, so nearest to what is compressed
        held.setdefault(row["lang"], []).append(row["text"].lower().encode("utf-8", "surrogatepass"))
    return {lang: b"\n".join(parts) for lang, parts in sorted(held.items())}


class Classifier:
    def __init__(self, content: dict[str, bytes], rules: LanguageRules):
        import zstandard

        self.langs, self.rules = list(content), rules
        self.compress = []
        for raw in content.values():
            how = zstandard.ZstdCompressionParameters.from_level(rules.level, source_size=rules.block_bytes, dict_size=len(raw), min_match=rules.min_match, search_log=rules.search_log, strategy=zstandard.STRATEGY_LAZY, write_checksum=0, write_content_size=0, write_dict_id=0)
            known = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(compression_params=how)
            self.compress.append(zstandard.ZstdCompressor(compression_params=how, dict_data=known).compress)

    def sizes(self, text: str) -> list[int]:
        raw, step = text.lower().encode("utf-8", "surrogatepass"), self.rules.block_bytes
        blocks = [raw[i : i + step] for i in range(0, len(raw), step)]
        return [sum(len(pack(b)) for b in blocks) for pack in self.compress]

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, accepted); the score is 1 over the sum of 2 to the power of minus the extra bytes, at its scale."""
        if not self.langs or not has_letter(text):
            return UNKNOWN, 0.0, False
        sizes = self.sizes(text)
        least = min(sizes)
        best = sizes.index(least)
        # Extra bytes weigh by the root of the size: margins of long texts are long, and so are their chance differences.
        scale = math.sqrt(least)
        score = 1 / sum(2 ** (-(s - least) / scale) for s in sizes)
        rest = [s for i, s in enumerate(sizes) if i != best]
        accepted = not rest or min(rest) - least >= self.rules.min_margin * least
        return self.langs[best], score, accepted


def classify(docs: DataFrame, content: dict[str, bytes], rules: LanguageRules = LanguageRules(), text_col: str = "text", out_col: str = "language") -> DataFrame:
    """``docs`` with ``out_col``: (lang, score, accepted) of each text; a column of that name is replaced."""
    small_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c != out_col]
    from pyspark.sql import types as T

    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(out_col, T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType())]))])
    at = keep.index(text_col)
    held: list[Classifier] = []

    def predictions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not held:
            held.append(Classifier(content, rules))
        for batch in batches:
            found = [held[0].predict(x.as_py()) for x in batch.column(at)]
            struct = pa.StructArray.from_arrays([pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()), pa.array([x[2] for x in found], pa.bool_())], names=["lang", "score", "accepted"])
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], names=[*batch.schema.names, out_col])

    return docs.select(*keep).mapInArrow(predictions, schema)


def is_held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def language_digest(docs: DataFrame, rules: LanguageRules = LanguageRules()) -> DataFrame:
    """doc_id, held_out, lang_pred, score and accepted of every row, learnt from the rows that are not held out."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    content = learn(rows.where(~is_held_out()), rules)
    found = classify(rows.select("doc_id", "text"), content, rules)
    return found.select("doc_id", is_held_out().alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"), F.col("language.accepted").alias("accepted"))

"""Quality rules: divergence of character-class and common-word histograms from language references.

Each text becomes two histograms: character classes (by UTF-8 byte) and common words (a fixed list for a few languages, all
other words in one class; capitals and sentence marks do not count).  The references are the summed histograms of all documents of a language
that pass the base rules, so they are gathered from the whole corpus, as one row of counts for each language and class.  A text is far from a language if
the Jensen-Shannon distance (base 2, 0 to 1) of its characters or of its words exceeds its threshold; it is rejected if it is
far from every reference.  A text without common words is only as far from a reference as that one's own share of common words puts it,
and short texts scatter, so the word threshold goes by reference and length (``word_limits``).  Texts under ``min_words`` words or ``min_chars`` characters (of any class) are too short to judge and pass the
divergence rule, as does everything where no language has ``min_reference_words`` words.

The base rules (too few words, too many repeated three-word windows) come first.

Defined results: null and empty texts have zero counts and fail the base rule; texts are used whole; repeated rows give
repeated results; an empty table gives an empty table; null languages give no reference, but their texts are judged all the
same.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, small_batches

#: Common words by language, from general knowledge of the languages.
COMMON_WORDS = {
    "en": "the of and to in is that it for was on with as be by at from are this not or have",
    "de": "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an",
    "fr": "le la les des et en un une du dans que est pour qui sur pas au par plus avec ne ce",
    "es": "el los las y se del al lo como más pero sus su con para por una no si ya o este",
    "it": "il di che è per non sono gli della nel alla ha dei anche più",
    "pt": "os um uma não com dos das em mais foi ao tem são à pelo",
    "nl": "het een van dat te zijn op aan voor er maar niet ook bij wordt",
}
SYMBOLS = "#*$%&|<>"
#: Marks that do not tell a common word from itself; A-Z counts as a-z there too.
SENTENCE_MARKS = b".,;:!?\"()[]"
BLANKS = " \t\n\r\x0b\x0c"


@dataclass(frozen=True)
class QualityRules:
    """Production parameters; distances are Jensen-Shannon distances in base 2."""

    min_words: int = 50
    repeat_percent: int = 50
    min_chars: int = 200
    min_reference_words: int = 2000
    max_char_distance: float = 0.30
    max_word_distance: float = 0.60
    word_tail: float = 0.001
    word_scatter: float = 1.1
    word_floor: float = 0.5


def _vocabulary() -> dict[bytes, int]:
    words = dict.fromkeys(w for line in COMMON_WORDS.values() for w in line.split())
    return {w.encode(): i for i, w in enumerate(words)}


VOCABULARY = _vocabulary()
N_WORD = len(VOCABULARY) + 1

#: Character classes by byte: 0 vowel, 1 other small letter, 2 vowel and 3 other capital, 4 digit, 5 blank, 6 line end,
#: 7 sentence mark, 8 other ASCII sign, 9 control, 10 to 12 first byte of a longer character.  Later bytes count nowhere.
N_CHAR = 13


def _byte_classes() -> np.ndarray:
    table = np.full(256, N_CHAR, dtype=np.intp)
    for b in range(128):
        c = chr(b)
        if c.isalpha():
            table[b] = (0 if c in "aeiou" else 1) if c.islower() else (2 if c in "AEIOU" else 3)
        elif c.isdigit():
            table[b] = 4
        elif c == " ":
            table[b] = 5
        elif c in "\n\r":
            table[b] = 6
        elif c in ".,;:!?'\"()-":
            table[b] = 7
        else:
            table[b] = 8 if 32 < b < 127 else 9
    table[0xC0:0xE0], table[0xE0:0xF0], table[0xF0:] = 10, 11, 12
    return table


BYTE_CLASSES = _byte_classes()


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    count = Counter(windows)
    inside = np.zeros(len(words), dtype=bool)
    hits = np.fromiter((count[w] > 1 for w in windows), dtype=bool, count=len(windows))
    for shift in range(3):
        inside[shift : shift + len(hits)] |= hits
    return int(inside.sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


def text_counts(text: str) -> tuple[list[int], np.ndarray, np.ndarray]:
    """[n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words], character histogram, word histogram."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    chars = np.bincount(BYTE_CLASSES[np.frombuffer(raw, dtype=np.uint8)], minlength=N_CHAR + 1)[:N_CHAR]
    common = np.zeros(N_WORD, dtype=np.int64)
    plain = raw.lower().translate(None, SENTENCE_MARKS).split()
    for word, n in Counter(filter(VOCABULARY.__contains__, plain)).items():
        common[VOCABULARY[word]] = n
    common[-1] = len(words) - common.sum()
    base = [len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), duplicate_lines(text), repeated_words(words)]
    return base, chars, common


def js_distances(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance, base 2, of each row of counts to each row of the reference; empty rows are at distance 1."""
    p = counts / np.maximum(counts.sum(1, keepdims=True), 1)
    q = reference / np.maximum(reference.sum(1, keepdims=True), 1)
    out = np.ones((len(p), len(q)))
    for k, row in enumerate(q):
        middle = (p + row) / 2
        with np.errstate(divide="ignore", invalid="ignore"):
            left = np.where(p > 0, p * np.log2(p / middle), 0).sum(1)
            right = np.where(row > 0, row * np.log2(row / middle), 0).sum(1)
        out[:, k] = np.where(counts.sum(1) > 0, np.sqrt(np.clip((left + right) / 2, 0, 1)), 1)
    return out


#: Lengths in words at which the word threshold is found; a text takes the greatest that it reaches.
LENGTHS = [50 * 2 ** (k / 2) for k in range(15)]


def word_limits(reference: np.ndarray, rules: QualityRules) -> np.ndarray:
    """The word threshold of each length (row) and reference (column).

    It is the distance that random texts of the reference's own words exceed with chance ``word_tail``, ``word_scatter`` times (real texts scatter
    more than random ones), at least ``word_floor`` times and always less than the distance of a text without common words, at most ``max_word_distance``.  Where a text of the reference may well
    have no common word (with chance ``word_tail`` or more), words cannot tell and it is ``max_word_distance``.
    """
    out = np.full((len(LENGTHS), len(reference)), rules.max_word_distance)
    bare = np.zeros((1, N_WORD))
    bare[0, -1] = 1
    for k, row in enumerate(reference):
        share, rng = row / row.sum(), np.random.default_rng(0)
        for i, n in enumerate(LENGTHS):
            if share[-1] ** int(n) < rules.word_tail:
                far = js_distances(bare, row[None])[0, 0]
                drawn = np.quantile(js_distances(rng.multinomial(int(n), share, 4000), row[None])[:, 0], 1 - rules.word_tail)
                out[i, k] = min(rules.max_word_distance, max(rules.word_floor * far, min(rules.word_scatter * drawn, 0.999 * far)))
    return out


def far_words(distances: np.ndarray, n_words: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Whether each text (row) is far from each reference by its words."""
    return distances > limits[np.maximum(np.searchsorted(LENGTHS, n_words, side="right") - 1, 0)]


_FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, char_hist binary, word_hist binary"


def _feature_batch(texts) -> list[pa.Array]:
    columns: list[list] = [[] for _ in range(7)]
    for text in texts:
        base, chars, common = text_counts(text.as_py() or "")
        for column, value in zip(columns, [*base, chars.astype("<i8").tobytes(), common.astype("<u4").tobytes()], strict=True):
            column.append(value)
    return [*[pa.array(c, pa.int64()) for c in columns[:5]], *[pa.array(c, pa.binary()) for c in columns[5:]]]


def quality_features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, lang, and the counts and histograms of ``text``, with every text read once."""
    small_batches(docs.sparkSession)
    chosen = docs.select(*keep, F.col("lang").cast("string").alias("lang"), "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]) + ", " + _FEATURES

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _FEATURES.split(", ")]
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *_feature_batch(batch.column(batch.num_columns - 1))], names=[*batch.schema.names[:-1], *names])

    return chosen.mapInArrow(features, schema)


def _is_sound(n_words, n_repeat_words, rules: QualityRules):
    """Whether texts of these counts pass the base rules."""
    return (n_words >= rules.min_words) & (100 * n_repeat_words <= rules.repeat_percent * n_words)


def _sum_batch(held: dict[str, np.ndarray]) -> pa.RecordBatch:
    rows = [(lang, i, int(n)) for lang, both in held.items() for i, n in enumerate(both) if n]
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int64())], names=["lang", "bin", "n"])


def _references(partial: DataFrame, rules: QualityRules) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """References from partial sums (lang, bin, n): one short row a language comes back."""
    total = partial.groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    per_lang = total.groupBy("lang").agg(F.sum(F.when(F.col("bin") >= N_CHAR, F.col("n"))).alias("words"), F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("bins"))
    found = {}
    for row in per_lang.where(F.col("words") >= rules.min_reference_words).collect():
        both = np.zeros(N_CHAR + N_WORD)
        for k, n in row["bins"].items():
            both[k] = n
        found[row["lang"]] = (both[:N_CHAR], both[N_CHAR:])
    return dict(sorted(found.items()))


def language_references(features: DataFrame, rules: QualityRules = QualityRules()) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Summed histograms of each language with ``min_reference_words`` words, from the rows that pass the base rules."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, chars, common in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                both = np.concatenate([np.frombuffer(chars, "<i8"), np.frombuffer(common, "<u4").astype(np.int64)])
                held[lang] = held[lang] + both if lang in held else both
        yield _sum_batch(held)

    sound = F.col("lang").isNotNull() & _is_sound(F.col("n_words"), F.col("n_repeat_words"), rules)
    return _references(features.where(sound).select("lang", "char_hist", "word_hist").mapInArrow(sums, "lang string, bin int, n long"), rules)


def text_references(docs: DataFrame, rules: QualityRules = QualityRules()) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """The same from the texts themselves, in one pass by one Python process a task."""
    small_batches(docs.sparkSession)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                base, chars, common = text_counts(text.as_py() or "")
                if _is_sound(base[0], base[4], rules):
                    both = np.concatenate([chars, common])
                    held[lang] = held[lang] + both if lang in held else both
        yield _sum_batch(held)

    labelled = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).where("lang is not null")
    return _references(labelled.mapInArrow(sums, "lang string, bin int, n long"), rules)


def judge(features: DataFrame, references: dict[str, tuple[np.ndarray, np.ndarray]], rules: QualityRules = QualityRules()) -> DataFrame:
    """The features without histograms, with base_failed, char_distance, word_distance, nearest_lang and kept."""
    langs = list(references)
    ref_chars = np.array([references[x][0] for x in langs]).reshape(len(langs), N_CHAR)
    ref_words = np.array([references[x][1] for x in langs]).reshape(len(langs), N_WORD)
    limits = word_limits(ref_words, rules)
    kept_fields = [f for f in features.schema.fields if f.name not in ("char_hist", "word_hist")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept_fields) + ", base_failed boolean, char_distance double, word_distance double, nearest_lang string, kept boolean"
    names = [f.name for f in kept_fields]

    def verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, repeats = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n_words", "n_repeat_words"))
            failed = ~_is_sound(n_words, repeats, rules)
            chars = np.array([np.frombuffer(x, "<i8") for x in batch.column("char_hist").to_pylist()]).reshape(batch.num_rows, N_CHAR)
            common = np.array([np.frombuffer(x, "<u4") for x in batch.column("word_hist").to_pylist()]).reshape(batch.num_rows, N_WORD)
            enough = (chars.sum(1) >= rules.min_chars) & (n_words >= rules.min_words)
            if langs:
                dc, dw = js_distances(chars, ref_chars), js_distances(common, ref_words)
                far = ((dc > rules.max_char_distance) | far_words(dw, n_words, limits)).all(1) & enough
                near = (dc + dw).argmin(1)
                at = np.arange(len(near))
                cols = [pa.array(dc[at, near]), pa.array(dw[at, near]), pa.array([langs[k] for k in near], pa.string())]
            else:
                far = np.zeros(batch.num_rows, dtype=bool)
                cols = [pa.nulls(batch.num_rows, pa.float64()), pa.nulls(batch.num_rows, pa.float64()), pa.nulls(batch.num_rows, pa.string())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(failed), *cols, pa.array(~failed & ~far)], names=[*names, "base_failed", "char_distance", "word_distance", "nearest_lang", "kept"])

    return features.mapInArrow(verdicts, schema)


def quality_digests(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """doc_id with counts and verdicts, one row for each row of ``docs``."""
    features = materialize(quality_features(docs.withColumn("doc_id", F.col("doc_id").cast("long")), ["doc_id"]), "quality")
    return judge(features, language_references(features, rules), rules).drop("lang")


def keep_good(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """The rows of ``docs`` that pass, unchanged: references from all rows first, then the verdict text by text in one pass."""
    references = text_references(docs, rules)
    langs = list(references)
    small_batches(docs.sparkSession)
    ref_chars = np.array([references[x][0] for x in langs]).reshape(len(langs), N_CHAR)
    ref_words = np.array([references[x][1] for x in langs]).reshape(len(langs), N_WORD)
    limits = word_limits(ref_words, rules)

    @F.udf("boolean", useArrow=True)
    def passes(text):
        base, chars, common = text_counts(text or "")
        if not _is_sound(base[0], base[4], rules):
            return False
        if not langs or chars.sum() < rules.min_chars:
            return True
        dc, dw = js_distances(chars[None].astype(float), ref_chars), js_distances(common[None].astype(float), ref_words)
        return bool(((dc <= rules.max_char_distance) & ~far_words(dw, np.array([base[0]]), limits)).any())

    return docs.where(passes(F.col("text")))

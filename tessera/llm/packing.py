"""Packing by power-of-two decomposition: documents split into binary-length pieces, equal lengths bucketed.

A document's ids (with the end id) are cut into pieces of the longest length, then into the powers of two of what is left, longest
first.  Each piece is a sequence of its own and sequences of one length form a bucket, so no sequence crosses documents and
none is padded.  Sequence ids are gapless, bucket by bucket, and numbered without gathering a bucket in one task.

Tokenizing goes by the distinct words of each Arrow batch, through a cache of the words seen before that each Python worker holds: the
tokenizer's pre-tokenizer never joins across white space, so a text's ids are those of its words in turn.  Words that the short way below does
not surely match go to the tokenizer's own ``encode``.

Defined results: a null or empty text is the end id alone, one piece of length 1; texts are used whole; repeated rows each give
their pieces; null ids pass through; an empty table gives an empty table.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, numbered, small_batches

MAX_LENGTH, END_ID = 2048, 1
CACHE_WORDS = 200_000
#: Bytes of text whose words are looked up at once; a longer text is taken by itself.
RUN_BYTES = 1 << 20


class WordIds:
    """Ids of whole texts by a file of the ``tokenizers`` library, word by word through a bounded cache.

    Two generations bound the memory: a batch that finds ``cache_words`` words or more in the young one starts anew, and words in use move up.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        small = self.tokenizer.get_vocab_size() <= 1 << 16
        self.kind, self.letter = np.dtype("<u2" if small else "<u4"), "H" if small else "I"
        self.limit = cache_words
        self.tokenize, self.packs = self.tokenizer.model.tokenize, {}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.cores: dict[str, bytes] = {}
        self.split = self.safe = None
        steps = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        before = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.by_word = steps == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in before] == ["Split", "ByteLevel"]
        if self.by_word:
            pattern = before[0]["pattern"]["Regex"]
            self.split = regex.compile(pattern)
            # The same on small ASCII letters, digits and signs, where the standard library's faster engine will do.
            self.split_ascii = re.compile(pattern.replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9"))
            self.safe_ascii = re.compile(r"[!-;=?-~]+")
            self.safe = re.compile(r"[!-;=?-~¡-ɏ]+")  # small letters of these come one by one; no "<" or ">": special tokens hold them
            self.shown = _byte_letters()

    def _packed(self, ids: list[int]) -> bytes:
        pack = self.packs.get(len(ids))
        if pack is None:
            pack = self.packs[len(ids)] = struct.Struct(f"<{len(ids)}{self.letter}").pack
        return pack(*ids)

    def _model(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.shown)
        return self._packed([x.id for x in self.tokenize(shown)])

    def _core(self, piece: str) -> bytes:
        """Ids of one piece of a word; a run of small ASCII letters is a word of its own and shares the words' cache."""
        known = self.young if piece.isascii() and piece.isalpha() else self.cores
        found = known.get(piece)
        if found is None:
            found = known[piece] = self._model(piece)
        return found

    def _fresh(self, word: str) -> bytes:
        """Ids of a word that no cache holds."""
        if word.isascii():
            if word.isalpha():  # one run of letters
                return self._packed([x.id for x in self.tokenize(word)]) if word.islower() else self._core(word.lower())
            if self.safe_ascii.fullmatch(word):
                return b"".join(map(self._core, self.split_ascii.findall(word.lower())))
        elif self.safe.fullmatch(word) and unicodedata.is_normalized("NFC", word):
            low = word.lower()
            return self._core(low) if low.isalpha() else b"".join(map(self._core, self.split.findall(low)))
        return self._packed(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def _of_words(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        if len(self.young) >= self.limit:
            self.old, self.young = self.young, {}
        if len(self.cores) >= self.limit:
            self.cores.clear()
        young, older, fresh = self.young, self.old.get, self._fresh
        found = list(map(young.get, words))
        for i, ids in enumerate(found):
            if ids is None:
                word = words[i]
                ids = older(word)
                if ids is None:
                    ids = fresh(word)
                found[i] = young[word] = ids
        return found

    def ids_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: empty) in one array, and at which places of it each begins and the last ends."""
        texts = pc.fill_null(texts, "")
        if not self.by_word:
            each = [self.tokenizer.encode(x, add_special_tokens=False).ids for x in texts.to_pylist()]
            return np.array([i for ids in each for i in ids], dtype="<u4"), np.cumsum([0, *map(len, each)])
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = words.flatten().dictionary_encode()
        found = self._of_words(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        ends = np.zeros(len(found) + 1, dtype=np.int32)
        np.cumsum(np.fromiter(map(len, found), dtype=np.int32, count=len(found)) // self.kind.itemsize, out=ends[1:])
        known = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), dtype=self.kind)))
        taken = known.take(coded.indices)
        # Arrays that were made anew, so their offsets start at 0.
        return taken.values.to_numpy().astype("<u4"), taken.offsets.to_numpy()[words.offsets.to_numpy()]

    def runs(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text in turn, looked up by runs of texts of :data:`RUN_BYTES` in all, so that a batch's words are not all held at once."""
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        first = 0
        while first < len(texts):
            before = int(sizes[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(sizes, before + RUN_BYTES, side="right")))
            found, places = self.ids_of(texts[first:last])
            for a, b in zip(places.tolist(), places[1:].tolist(), strict=False):
                yield found[a:b]
            first = last

    def ids(self, text: str) -> np.ndarray:
        return self.ids_of(pa.array([text], pa.string()))[0]


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in prints]
    return {b: 256 + i for i, b in enumerate(others)}


def pieces_of(n: int, longest: int = MAX_LENGTH) -> list[int]:
    """Lengths of the pieces of ``n`` ids: whole ``longest`` ones, then the powers of two of the rest, falling."""
    whole, rest = divmod(n, longest)
    return [longest] * whole + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


_encoders: dict[str, WordIds] = {}


def _encoder(path: str) -> WordIds:
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]


def pack_documents(docs: DataFrame, tokenizer: str | None = None, longest: int = MAX_LENGTH, end_id: int = END_ID, keep_ids: bool = True, spread: int = 256, rank: tuple[str, ...] = ()) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids.

    ``longest`` is a power of two.  ``tokenizer`` is the path of a tokenizers file, the same on all executors.  ``spread`` cuts each
    bucket, for the numbering of its sequences, into so many sub-groups.  ``rank`` names columns that give the order of the documents, so of the sequences in each bucket; the
    first should have few values (a file's name, say), as the numbering goes by it.  Without it the order is that of a hash.
    """
    if longest & longest - 1 or longest < 1:
        raise ValueError("longest must be a power of two")
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    small_batches(docs.sparkSession)
    path = str(tokenizer)
    ranks = docs.select(*[F.col(c).alias(f"_rank{i}") for i, c in enumerate(rank)]).schema.fields
    extra = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in ranks)
    schema = extra + "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * keep_ids

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            rows: list[list] = [[] for _ in range(5)]
            held, counts = [], []
            for doc_id, found in zip(batch.column(0).to_pylist(), encoder.runs(batch.column(1)), strict=True):
                ids = np.append(found, np.uint32(end_id))
                start, before = 0, len(rows[0])
                for size in pieces_of(len(ids), longest):
                    part = ids[start : start + size]
                    for column, value in zip(rows, (doc_id, start, size, zlib.crc32(part.tobytes()), len(ids)), strict=True):
                        column.append(value)
                    if keep_ids:
                        held.append(part.astype(np.int32))
                    start += size
                counts.append(len(rows[0]) - before)
            columns = [pa.array(c, pa.int64()) for c in rows]
            if keep_ids:
                columns.append(pa.array(held, pa.list_(pa.int32())))
            of = pa.array(np.repeat(np.arange(len(counts)), counts))
            passed = [batch.column(2 + i).take(of) for i in range(len(ranks))]
            yield pa.RecordBatch.from_arrays([*passed, *columns], names=[*[f.name for f in ranks], *["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: len(columns)]])

    cut = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[F.col(c).alias(f.name) for c, f in zip(rank, ranks, strict=True)]).mapInArrow(pieces, schema), "pieces")
    order = [*[f.name for f in ranks[1:]], "doc_id", "start", "ids_crc32", "doc_tokens"]
    cut = cut.withColumn("_sub", F.col("_rank0") if ranks else F.pmod(F.xxhash64("doc_id", "start"), F.lit(spread)).cast("int"))
    inside = numbered(cut, "length", "_sub", order, "_in_bucket")
    # Bounded: one row for each power of two up to ``longest``.
    from pyspark.sql import Window

    before = cut.groupBy("length").agg(F.count(F.lit(1)).alias("_n")).select(F.col("length").alias("_l"), F.coalesce(F.sum("_n").over(Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_first"))
    placed = inside.join(F.broadcast(before), F.col("length") == F.col("_l"))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("_first") + F.col("_in_bucket")).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"), *["ids"] * keep_ids)

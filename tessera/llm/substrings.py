"""Substring dedup: suffix automata of reference shards, matching statistics, removal of maximal repeated spans.

A window is ``window`` consecutive words of one document; a word goes if some window over it has a word sequence that also starts anywhere
else.  The reference is the corpus itself, so broadcasting automata of all of it to all documents would cost the square of
the corpus and memory in its proportion.  Instead windows and reference are cut alike, by content, and meet in shards:

1. Every window has an anchor, the ``gram`` words with the least hash inside it (ties: the first).  Consecutive windows of one anchor form
   a segment.  Equal windows have equal anchors, so only segments of anchors that occur twice or more can matter;
   anchors are counted over all documents, and documents without such an anchor are left as they are.
2. Segments, the pieces of both reference and documents, are aggregated to distinct ones with their numbers.  An anchor that
   occurs more than ``frequent`` times sends its windows one by one, each under a key of its own, so no key holds a large group.
3. A shard is a run of keys with at most about ``shard_words`` words.  Its suffix automaton (over words, with the number of places of
   every state) is built in the task that holds it, and the shard's segments stream through it for matching statistics: the state of the
   last ``window`` words at each word tells in how many places they stand.  Every marked word has been through an automaton.
4. Marks go back to the documents, where overlapping windows join to maximal spans, which are removed.

What counts as repeated is decided on the words themselves inside a shard.  Segments and documents are named by 64-bit hashes, so two different
ones of one name (expected among some 10^9 of one key's segments, or of all documents) would be taken for one.  Repeats are judged on the input.

Defined results: null and empty texts have no words; texts under ``window`` words are left whole; texts are used whole; repeated rows count
as documents of their own, so their windows repeat; an empty table gives an empty table; words are never changed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, partitions, small_batches
from .jaccard import window_hashes, word_hashes


@dataclass(frozen=True)
class RepeatRules:
    """Production parameters, in words but for ``frequent``, a number of places, and ``remembered``, a number of segments a task."""

    window: int = 35
    gram: int = 12
    frequent: int = 2000
    shard_words: int = 100_000
    remembered: int = 200_000


_PLACE = 24
_STEP = 1 << 23


def segments(hashes: np.ndarray, rules: RepeatRules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, anchor) of each segment of a text."""
    n = len(hashes) - rules.window + 1
    if n < 1:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.int64),)
    grams = window_hashes(hashes, rules.gram)
    width = rules.window - rules.gram + 1
    places = []
    for at in range(0, n, _STEP):  # the place within a step fits into the low bits
        part = grams[at : at + _STEP + width - 1]
        least = (part & ~np.uint64((1 << _PLACE) - 1)) | np.arange(len(part), dtype=np.uint64)
        wide = 1
        while 2 * wide <= width:
            least = np.minimum(least[:-wide], least[wide:])
            wide *= 2
        if wide < width:
            least = np.minimum(least[: len(least) - (width - wide)], least[width - wide :])
        places.append((least & np.uint64((1 << _PLACE) - 1)).astype(np.int64) + at)
    place = np.concatenate(places)
    starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    return starts, np.r_[starts[1:], n] - 1, grams[place[starts]].view(np.int64)


class SuffixAutomaton:
    """Suffix automaton of several word sequences; ``places`` counts where each state's words stand, by the sequences' numbers."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.size, self.places = [-1], [0], [0]

    def _state(self, size: int, after: dict, link: int) -> int:
        self.next.append(after)
        self.size.append(size)
        self.link.append(link)
        self.places.append(0)
        return len(self.size) - 1

    def _split(self, p: int, c, q: int) -> int:
        """The state for ``p`` and ``c`` at length size(p) + 1, cut out of ``q`` if that is longer."""
        if self.size[p] + 1 == self.size[q]:
            return q
        cut = self._state(self.size[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = cut
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = cut
            p = self.link[p]
        return cut

    def add(self, words: list, times: int) -> None:
        """Add a sequence that stands in ``times`` places."""
        last = 0
        for c in words:
            p = last
            q = self.next[p].get(c)
            if q is not None:
                last = self._split(p, c, q)
            else:
                last = self._state(self.size[p] + 1, {}, 0)
                while p >= 0 and c not in self.next[p]:
                    self.next[p][c] = last
                    p = self.link[p]
                self.link[last] = self._split(p, c, self.next[p][c]) if p >= 0 else 0
            self.places[last] += times

    def close(self) -> None:
        """Sum the places along the links, longest states first."""
        for s in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.places[self.link[s]] += self.places[s]

    def repeated(self, words: list, window: int) -> int:
        """Bits of the windows of ``words`` that stand in two places or more, by matching statistics: at each word, the longest run that the automaton knows.

        Where a word does not go on, the suffix links lead to the longest shorter run that it does go on from.
        """
        state = length = bits = 0
        for i, c in enumerate(words):
            after = self.next[state].get(c)
            while after is None and state:
                state = self.link[state]
                length = self.size[state]
                after = self.next[state].get(c)
            if after is None:
                continue
            state, length = after, length + 1
            if length >= window:
                while self.size[self.link[state]] >= window:
                    state = self.link[state]
                    length = self.size[state]
                if self.places[state] > 1:
                    bits |= 1 << (i - window + 1)
        return bits


def shard_marks(units: list[tuple[int, int, int, bytes]], rules: RepeatRules) -> list[tuple[int, int, int]]:
    """(key, unit, bits) of a shard's units (key, unit, times, words); all units of a key are in the shard."""
    machine, streamed = SuffixAutomaton(), [(key, unit, times, text.split(b" ")) for key, unit, times, text in units]
    for _, _, times, words in streamed:
        machine.add(words, times)
    machine.close()
    return [(key, unit, bits) for key, unit, _, words in streamed if (bits := machine.repeated(words, rules.window))]


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def repeated_windows(docs: DataFrame, rules: RepeatRules = RepeatRules()) -> DataFrame:
    """doc_key and marks, an array of (first, bits), for each document with a repeated window; doc_key hashes id and text."""
    spark = docs.sparkSession
    small_batches(spark)
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("doc_key"), "text")

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, keys = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for key, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found.append(segments(word_hashes(_words(x.as_py())), rules)[2])
                keys.append(np.full(len(found[-1]), key, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.array(np.concatenate(keys))], names=["anchor", "doc_key"])

    placed = keyed.mapInArrow(anchors, "anchor long, doc_key long")
    often = materialize(placed.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("anchor", (F.col("m") > rules.frequent).alias("frequent")), "anchors")
    wanted = placed.join(often, "anchor").groupBy("doc_key").agg(F.collect_set(F.struct("anchor", "frequent")).alias("anchors"))
    wanted = materialize(wanted, "wanted")

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        sent: set[tuple[int, int]] = set()
        short = xxhash.xxh3_64_intdigest
        for batch in batches:
            rows: list[tuple] = []

            def emit(key: int, text: bytes, doc_key: int, first: int, rows=rows) -> None:
                unit = short(text) - (1 << 63)
                fresh = (key, unit) not in sent
                if fresh:
                    if len(sent) >= rules.remembered:
                        sent.clear()
                    sent.add((key, unit))
                rows.append((key, unit, doc_key, first, text if fresh else None))

            for doc_key, x, chosen in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                words = _words(x.as_py())
                kinds = {a["anchor"]: a["frequent"] for a in chosen}
                for first, last, anchor in zip(*map(np.ndarray.tolist, segments(word_hashes(words), rules)), strict=True):
                    kind = kinds.get(anchor)
                    if kind is None:
                        continue
                    if kind:
                        for w in range(first, last + 1):
                            text = b" ".join(words[w : w + rules.window])
                            emit(short(text, seed=1) - (1 << 63), text, doc_key, w)
                    else:
                        emit(anchor, b" ".join(words[first : last + rules.window]), doc_key, first)
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.binary())], names=["key", "unit", "doc_key", "first", "words"])

    cut = keyed.join(wanted, "doc_key").select("doc_key", "text", "anchors").mapInArrow(units, "key long, unit long, doc_key long, first long, words binary")
    cut = materialize(cut, "segments")
    distinct = cut.groupBy("key", "unit").agg(F.count(F.lit(1)).alias("times"), F.max("words").alias("words"))
    sharded = distinct.repartition(max(4, partitions(spark)), "key").sortWithinPartitions("key")

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush(units: list[tuple]) -> pa.RecordBatch:
            found = shard_marks(units, rules)
            columns = list(zip(*found, strict=True)) if found else [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["key", "unit", "bits"])

        for batch in batches:
            for unit in zip(*[batch.column(k).to_pylist() for k in range(4)], strict=True):
                if size >= rules.shard_words and unit[0] != held[-1][0]:
                    yield flush(held)
                    held, size = [], 0
                held.append(unit)
                size += unit[3].count(b" ") + 1
        if held:
            yield flush(held)

    marked = sharded.mapInArrow(marks, "key long, unit long, bits long").where("bits <> 0")
    back = cut.select("key", "unit", "doc_key", "first").join(materialize(marked, "marks"), ["key", "unit"])
    return back.groupBy("doc_key").agg(F.collect_set(F.struct("first", "bits")).alias("marks"))


def covered(n: int, marks: list, window: int) -> np.ndarray:
    """Which of ``n`` words lie in a marked window."""
    change = np.zeros(n + 1, dtype=np.int64)
    for mark in marks:
        bits, first = mark["bits"], mark["first"]
        while bits:
            low = bits & -bits
            run = ((bits + low) ^ bits) & bits if bits + low else bits
            count = run.bit_length() - low.bit_length() + 1
            at = first + low.bit_length() - 1
            change[at] += 1
            change[at + count - 1 + window] -= 1
            bits &= ~run
    return np.cumsum(change[:-1]) > 0


def remove_repeats(docs: DataFrame, rules: RepeatRules = RepeatRules()) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by blanks) and spans (of words removed) of every row."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    marked = materialize(repeated_windows(rows, rules), "marks")
    small_batches(spark)
    joined = rows.withColumn("doc_key", F.xxhash64("doc_id", "text")).join(marked, "doc_key", "left").select("doc_id", "text", "marks")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, x, marks in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                words = _words(x.as_py())
                gone = covered(len(words), marks or [], rules.window)
                edge = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
                left = [w for w, g in zip(words, gone.tolist(), strict=True) if not g] if len(edge) else words
                out.append((doc_id, len(words), int(gone.sum()), b" ".join(left).decode("utf-8", "surrogatepass"), [{"start": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)]))
            columns = list(zip(*out, strict=True)) if out else [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "n_words", "n_removed", "kept", "spans"])

    return joined.mapInArrow(kept, "doc_id long, n_words long, n_removed long, kept string, spans array<struct<start:long,end:long>>")


def repeat_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row."""
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: DuckDB: every window as text, counted over all documents; words under a repeated one go.
ORACLE_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT r, unnest(range(1, CAST(greatest(len(w) - 33, 1) AS BIGINT))) AS i FROM words),
windows AS (SELECT s.r, s.i, md5(array_to_string(w.w[s.i:s.i + 34], ' ')) AS h FROM starts s JOIN words w USING (r)),
often AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
hits AS (SELECT r, list(DISTINCT p) AS gone FROM (SELECT r, unnest(range(i, i + 35)) AS p FROM windows WHERE h IN (SELECT h FROM often)) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_transform(list_sort(list_filter(range(1, CAST(len(w) + 1 AS BIGINT)), lambda k: NOT list_contains(gone, k))), lambda k: w[k]) END, ' ')) AS kept_sha256
FROM words LEFT JOIN hits USING (r)
"""

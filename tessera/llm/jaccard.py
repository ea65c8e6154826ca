"""N-gram Jaccard join: size-aware heavy-light join of shingle sets, and the components of its links.

Two documents link when their sets of five-word shingles have a Jaccard similarity of ``threshold`` or more.  Sets are sorted arrays of
64-bit shingle hashes; documents of equal sets are one class, named by a 64-bit hash of its set.

1. *Pruning.* A set of n shingles that links to another shares at least ceil(t n) of them, so at most n - ceil(t n) are its own
   alone.  Of each class the first n - ceil(t n) + 1 (and ``slack`` n more) shingles by hash are looked at; classes with more
   than n - ceil(t n) shingles that no other class has among its own go, and then, with the lower half of all hashes and with whole sets, those that still have.
2. *Light sets* enumerate the pairs (subsets of fixed size 2) of their prefix, rarest shingles first, one shingle longer than the
   prefix filter needs: two linked sets have two of those in common.  *Heavy sets* scan the inverted lists of their prefix instead, in
   which all sets are listed.  The boundary between light and heavy is the size with the least cost: pairs enumerated
   below, list entries scanned above (pivots make a list cost its length, not its square).
3. *Groups* of classes with one subset or one list are not expanded into pairs; groups of the same members count once.  A pair need only be met in
   the first subset (or list) that both have; if that is at place i of a set of n, at most n - i shingles are shared (one more for a pair of
   shingles), so pairs whose sizes and places leave less than the threshold needs are never made.  In a round, each group's pivot
   (``pivots`` times as many in each further round) is compared, with whole sets, with the members that are not in its component
   yet; then the pivots leave.  Large groups of near copies become one component in the first round.  As soon as the pairs of members of different components
   are no more than ``rest`` for each member, they are compared directly; groups end when all their members are in one component.  So no
   link between components is lost.

Nothing is capped and no group is gathered in one task: groups are aggregated before the shuffle and joined by sort-merge joins that Spark
can split.

Defined results: null and empty texts, and texts without words, have the empty set, link with nothing and are their own component;
fewer than five words are one shingle; repeated rows are one class; of rows with a null id the component is the least id in it, or
null if there is none; an empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names, materialize, release, small_batches

NULL_ID = -(1 << 63)

#: Cost of an entry of a scanned list against that of an enumerated pair: the entry is joined with its list's pivots and verified.
SCAN_COST = 4.0


@dataclass(frozen=True)
class JoinRules:
    """Production parameters: words a shingle, threshold in hundredths, slack of the first pruning, growth of the pivots, pairs a member for the last round."""

    words: int = 5
    percent: int = 75
    slack: float = 0.04
    pivots: int = 16
    rest: float = 2.0


_ODD = [np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) | 1) for k in range(64)]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each window of ``width`` words; of all words if there are fewer."""
    width = min(width, len(hashes))
    if not width:
        return np.empty(0, dtype=np.uint64)
    n = len(hashes) - width + 1
    out = np.full(n, np.uint64(width), dtype=np.uint64)
    for k in range(width):
        out += hashes[k : k + n] * _ODD[k % 64]
    return _mixed(out)


def shingle_set(text: str | None, words: int = 5) -> np.ndarray:
    """The sorted distinct shingle hashes of a text, A-Z in lower case."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    return np.unique(window_hashes(word_hashes(raw.split()), words))


def set_name(shingles: np.ndarray) -> int:
    import xxhash

    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes()))))


def _spare(n: Column, percent: int) -> Column:
    """n - ceil(percent n / 100): the most shingles of n that a linked set may lack."""
    return n - F.ceil(n * F.lit(percent) / F.lit(100.0))


def _looked_at(n: int, rules: JoinRules) -> int:
    return min(n, n - -(-rules.percent * n // 100) + 1 + int(rules.slack * n))


def classes(docs: DataFrame, rules: JoinRules = JoinRules()) -> DataFrame:
    """doc_id, digest (of the text), n (set size) and node (the class) of every row."""
    small_batches(docs.sparkSession)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(x.as_py(), rules.words) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(map(len, found), pa.int64()), pa.array(map(set_name, found), pa.int64())], names=["doc_id", "digest", "n", "node"])

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("digest"), text.alias("text")).mapInArrow(sets, "doc_id long, digest long, n long, node long")


def _first_pruning(docs: DataFrame, named: DataFrame, rules: JoinRules) -> DataFrame:
    """node, n and row (id and digest of one of its documents) of the classes that may link."""

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, names = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for x in batch.column(0):
                found = shingle_set(x.as_py(), rules.words)
                if len(found) > 1:
                    parts.append(found[: _looked_at(len(found), rules)])
                    names.append(np.full(len(parts[-1]), set_name(found), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(parts).view(np.int64)), pa.array(np.concatenate(names))], names=["shingle", "node"])

    listed = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(prefixes, "shingle long, node long")
    alone = listed.groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("other")).where("node = other")
    own = alone.groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    one = named.where("n > 1").groupBy("node").agg(F.first("n").alias("n"), F.min(F.struct(F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"), "digest")).alias("row"))
    return one.join(own.hint("merge"), "node", "left").where(F.coalesce("own", F.lit(0)) <= _spare(F.col("n"), rules.percent)).select("node", "n", "row.id", "row.digest")


def _whole_sets(docs: DataFrame, chosen: DataFrame, rules: JoinRules) -> DataFrame:
    """node, n and shingles of the chosen classes; a class twice if its row is repeated.

    Joins here and below are merged at every size: no side has a bound, and a plan that broadcasts small ones would hide what large ones move.
    """
    text = F.col("text").cast("string")
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"), F.xxhash64(text).alias("digest"), text.alias("text"))
    joined = texts.join(chosen.select("id", "digest", "node").hint("merge"), ["id", "digest"]).select("node", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, found = [], []
            for node, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                made = shingle_set(x.as_py(), rules.words)
                if set_name(made) == node:  # another text may have the same digest
                    nodes.append(node)
                    found.append(made.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(map(len, found), pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["node", "n", "shingles"])

    return joined.mapInArrow(sets, "node long, n long, shingles array<long>")


def _half_pruning(whole: DataFrame, rules: JoinRules) -> DataFrame:
    """Nodes of the whole sets that may link, by the shingles in the lower half of all hashes: as the first pruning, among fewer classes.

    The half is one of values, not of places in a set: a shingle that two sets share is in the halves of both, whatever their sizes, so
    those of one's own there are never more than the whole set's.
    """
    half = whole.select("node", F.explode("shingles").alias("shingle")).where("shingle >= 0")
    alone = half.groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("other")).where("node = other")
    own = alone.groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    return whole.select("node", "n").distinct().join(own.hint("merge"), "node", "left").where(F.coalesce("own", F.lit(0)) <= _spare(F.col("n"), rules.percent)).select("node")


def _ranked_sets(whole: DataFrame, rules: JoinRules) -> DataFrame:
    """node, n, own and shared: the shingles that others have too, as (lists' length, shingle), shortest lists first."""
    rows = whole.select("node", "n", F.explode("shingles").alias("shingle"))
    often = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    held = rows.join(often.hint("merge"), "shingle").groupBy("node").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("f", "shingle"))).alias("shared"))
    held = held.withColumn("own", F.col("n") - F.size("shared"))
    return held.where(F.col("own") <= _spare(F.col("n"), rules.percent))


def _boundary(ranked: DataFrame) -> int:
    """The set size up to which sets are light: least total of pairs enumerated below and list entries scanned above."""
    cost = ranked.groupBy(F.floor(4 * F.log2(F.col("n").cast("double"))).alias("size")).agg(
        F.max("n").alias("most"),
        F.sum(F.size("longer").cast("double") * (F.size("longer") - 1) / 2).alias("pairs"),
        F.sum(F.lit(SCAN_COST) * F.size("prefix")).alias("scans"),
    )
    rows = sorted((r["most"], r["pairs"], r["scans"]) for r in cost.collect())  # four rows for each doubling of the size
    totals = [(sum(r[1] for r in rows[:k]) + sum(r[2] for r in rows[k:]), rows[k - 1][0] if k else 0) for k in range(len(rows) + 1)]
    return min(totals)[1] if totals else 0


def _groups(ranked: DataFrame, limit: int) -> DataFrame:
    """key, node, n, own, left, heavy and listed: the subsets of light sets, and the lists that heavy sets scan with everyone listed.

    ``left`` is the most shingles that the set can share with one that has no earlier subset (or list) in common with it.
    """
    heavy, after = F.col("n") > limit, F.col("n") - F.col("own")
    base = ["node", "n", "own"]
    second = lambda x, i: F.transform(F.slice("longer", i + 2, F.size("longer")), lambda y, k: F.struct(F.xxhash64(F.lit("pair"), x, y).alias("key"), (after - i - k).alias("left")))
    light = ranked.where(~heavy).select(F.explode(F.flatten(F.transform("longer", second))).alias("e"), *base, F.lit(False).alias("heavy"))
    lists = ranked.select(F.explode(F.transform("prefix", lambda x, i: F.struct(F.xxhash64(F.lit("list"), x).alias("key"), (after - i).alias("left")))).alias("e"), *base, heavy.alias("heavy"))
    light, lists = (x.select("e.key", *base, F.col("e.left").cast("long").alias("left"), "heavy") for x in (light, lists))
    scanned = lists.groupBy("key").agg(F.max("heavy").alias("any_heavy"), F.count(F.lit(1)).alias("m")).where("any_heavy and m > 1").select("key")
    shared = light.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("key")
    return light.join(shared.hint("merge"), "key").withColumn("listed", F.lit(False)).unionByName(lists.join(scanned.hint("merge"), "key").withColumn("listed", F.lit(True)))


def _distinct_groups(groups: DataFrame) -> DataFrame:
    """One group of those with the same members, the first one, which leaves most: shingles of a passage that the same sets share make the same pairs.

    Groups are told apart by their kind, number of members and two 64-bit digests of the members.
    """
    marks = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"x{k}") for k in range(2)]
    seen = groups.groupBy("key", "listed").agg(F.count(F.lit(1)).alias("m"), F.sum("left").alias("total"), *marks)
    kept = seen.groupBy("listed", "m", "x0", "x1").agg(F.max(F.struct("total", "key")).alias("first")).select("first.key", "listed")
    return groups.join(kept.hint("merge"), ["key", "listed"], "left_semi")


def _may_link(left: Column, sizes: Column, percent: int) -> Column:
    """Whether ``left`` shared shingles of sets of ``sizes`` in all reach the threshold."""
    return F.lit(100 + percent) * left >= F.lit(percent) * sizes


def _with_labels(groups: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return groups.withColumn("label", F.col("node"))
    return groups.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _open_groups(groups: DataFrame, labels: DataFrame | None, rules: JoinRules) -> DataFrame:
    """The members, with labels, that may still link to a member of another component in their group."""
    held = materialize(_with_labels(groups, labels), "members")
    least = [F.min("n").alias("n0"), F.max("left").alias("left1"), F.min("label").alias("l0"), F.max("label").alias("l1"), F.max("heavy").alias("any_heavy")]
    alive = held.groupBy("key").agg(*least).where("l0 <> l1")
    near = held.join(alive.select("key", "n0", "left1", "any_heavy").hint("merge"), "key")
    open_ = near.where(_may_link(F.least("left", "left1"), F.col("n") + F.col("n0"), rules.percent) & (~F.col("listed") | F.col("any_heavy"))).select(*held.columns)
    out = materialize(open_, "held")
    release(held)
    return out


def _rest(held: DataFrame) -> tuple[int, int]:
    """Members, and pairs of members of different components in a group, of all groups."""
    sizes = held.groupBy("key", "label").agg(F.count(F.lit(1)).alias("m")).groupBy("key").agg(F.sum("m").alias("m"), F.sum(F.col("m").cast("double") * F.col("m")).alias("same"))
    row = sizes.agg(F.sum("m").alias("members"), F.sum((F.col("m").cast("double") * F.col("m") - F.col("same")) / 2).alias("pairs")).first()
    return row["members"] or 0, row["pairs"] or 0


def _pairs(held: DataFrame, others: DataFrame, rules: JoinRules, once: bool) -> DataFrame:
    """Distinct (a, b) of members of ``held`` and ``others`` of a group that may link and are of different components."""
    names = ["node", "n", "left", "heavy", "label"]
    two = others.select("key", *[F.col(c).alias(f"o_{c}") for c in names])
    meet = _may_link(F.least("left", "o_left"), F.col("n") + F.col("o_n"), rules.percent) & (F.col("label") != F.col("o_label")) & (~F.col("listed") | F.col("heavy") | F.col("o_heavy"))
    if once:
        meet &= F.col("node") < F.col("o_node")
    return held.join(two.hint("merge"), "key").where(meet).select(F.least("node", "o_node").alias("a"), F.greatest("node", "o_node").alias("b")).distinct()


def _verified(pairs: DataFrame, whole: DataFrame, rules: JoinRules) -> DataFrame:
    """The pairs (a, b) that link, by their whole sets."""
    one = whole.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    two = whole.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.hint("merge").join(two, "b").hint("merge").join(one, "a")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(100 * common >= rules.percent * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of the links; label is the least node of its component.  By least neighbours and pointer jumps."""
    edges = materialize(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    first = labels = materialize(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        least = labels.join(near, "node").select("node", F.least("label", "near").alias("to"), F.col("label").alias("was"))
        jumped = least.join(labels.select(F.col("node").alias("to"), F.col("label").alias("far")), "to", "left")
        nearer = materialize(jumped.select("node", F.least("to", F.coalesce("far", "to")).alias("label"), "was"), "labels")
        release(first)
        first, labels = nearer, nearer.select("node", "label")
        if not nearer.where("label <> was").limit(1).count():
            release(edges)
            return nearer


def _relabelled(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels after further links: components of the links between the old labels, then the nodes' new ones."""
    if labels is None:
        return components(links)
    labels = labels.select("node", "label")
    for side in ("a", "b"):
        links = links.join(labels.select(F.col("node").alias(side), F.col("label").alias(f"l{side}")), side, "left").withColumn(f"l{side}", F.coalesce(f"l{side}", side))
    joined = components(links.select(F.col("la").alias("a"), F.col("lb").alias("b")))
    to = joined.select(F.col("node").alias("label"), F.col("label").alias("to"))
    moved = labels.join(to, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    fresh = joined.join(labels, "node", "left_anti").select("node", "label")
    made = materialize(moved.unionByName(fresh), "labels")
    release(joined)
    return made


def _compared_sets(docs: DataFrame, named: DataFrame, rules: JoinRules) -> tuple[DataFrame, DataFrame]:
    """Whole sets (node, n, shingles) that may link, and their prefixes (node, n, own, prefix, longer)."""
    chosen = materialize(_first_pruning(docs, named, rules), "chosen")
    whole = materialize(_whole_sets(docs, chosen, rules), "sets")
    halves = materialize(_half_pruning(whole, rules), "halves")
    kept = materialize(whole.join(halves.hint("merge"), "node", "left_semi").dropDuplicates(["node"]), "kept")
    release(chosen, whole, halves)
    ranked = _ranked_sets(kept, rules)
    # Shingles of one's own come first in the order, so they take up the prefix's first places.
    room = _spare(F.col("n"), rules.percent) - F.col("own")
    for name, more in (("prefix", 1), ("longer", 2)):
        ranked = ranked.withColumn(name, F.transform(F.slice("shared", F.lit(1), F.greatest(F.lit(0), room + more).cast("int")), lambda x: x["shingle"]))
    ranked = materialize(ranked.select("node", "n", "own", "prefix", "longer"), "prefixes")
    # Each round compares whole sets, so those that are in no group must not be moved again.
    compared = materialize(kept.join(ranked.select("node").hint("merge"), "node", "left_semi"), "compared")
    release(kept)
    return compared, ranked


def linked_classes(docs: DataFrame, named: DataFrame, rules: JoinRules = JoinRules()) -> DataFrame | None:
    """(node, label) of all classes that link to another, or None if none does."""
    whole, ranked = _compared_sets(docs, named, rules)
    lists = materialize(_groups(ranked, _boundary(ranked)), "lists")
    groups = materialize(_distinct_groups(lists), "groups")
    release(ranked, lists)
    used, tested, labels = [groups], None, None
    salts = 1
    while True:
        held = _open_groups(groups, labels, rules)
        used.append(held)
        members, rest = _rest(held)
        if not members:
            break
        last = salts > 1 and rest <= rules.rest * members
        pivots = held
        if not last:
            # One pivot of each group at first, then one for each salt, of which there are more in each round; in lists heavy sets first, then those with the least of their own.
            salt = F.lit(0) if salts == 1 else F.pmod(F.xxhash64("node", F.lit(salts)), F.lit(salts))
            first = F.struct((~F.col("heavy")).alias("light"), (F.col("own") / F.col("n")).alias("part"), "node", "label", "n", "left", "heavy")
            pivots = held.groupBy("key", salt.alias("salt")).agg(F.min(first).alias("p")).select("key", *[F.col(f"p.{c}").alias(c) for c in ("node", "label", "n", "left", "heavy")])
            pivots = materialize(pivots, "pivots")
            used.append(pivots)
        pairs = _pairs(held, pivots, rules, last)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        used.append(pairs)
        tested = pairs if tested is None else tested.union(pairs)
        found = materialize(_verified(pairs, whole, rules), "links")
        used.append(found)
        if found.limit(1).count():
            known, labels = labels, _relabelled(labels, found)
            release(known)
        if last:
            break
        groups = held.drop("label").join(pivots.select("key", "node"), ["key", "node"], "left_anti")
        salts *= rules.pivots
    release(whole, *used)
    return labels


def _placed(docs: DataFrame, rules: JoinRules) -> DataFrame:
    """doc_id, digest, n and component (its least class) of every row."""
    named = materialize(classes(docs, rules), "classes")
    labels = linked_classes(docs, named, rules)
    if labels is None:
        return named.select("doc_id", "digest", "n", F.col("node").alias("component"))
    placed = named.join(labels.select("node", "label"), "node", "left")
    return placed.select("doc_id", "digest", "n", F.coalesce("label", "node").alias("component"))


def jaccard_components(docs: DataFrame, rules: JoinRules = JoinRules()) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: the least doc_id reachable by links."""
    placed = _placed(docs, rules)
    linked = placed.where("n > 0")
    least = linked.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named_rows = linked.join(least, "component").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return named_rows.unionByName(placed.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def keep_one_of_each(docs: DataFrame, rules: JoinRules = JoinRules()) -> DataFrame:
    """One row of ``docs`` of each component, columns unchanged: that of the least id (null ids last), then of the least digest of its text.

    A row without words is its own component and stays, so rows go by component and never by id: different texts that share an id, or have
    none, are all kept.  Rows of one component have the chosen id and digest only if their texts are the same; one of them is kept.
    """
    key, none, digest = keys = free_names(docs.columns, "_key", "_none", "_digest")
    least = _placed(docs, rules).where("n > 0").groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("x"))
    chosen = least.select(F.coalesce("x.doc_id", F.lit(NULL_ID)).alias(key), F.col("x.none").alias(none), F.col("x.digest").alias(digest))
    id_, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    wordless = ~F.coalesce(text, F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    keyed = docs.where(~wordless).withColumns({key: F.coalesce(id_, F.lit(NULL_ID)), none: id_.isNull(), digest: F.xxhash64(text)})
    return keyed.join(chosen, keys).dropDuplicates(keys).select(*docs.columns).unionByName(docs.where(wordless))


#: DuckDB: all links between distinct sets by counting common shingles, then least ids along the links.
ORACLE_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, CAST(len(w) - 3 AS BIGINT)), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS c
  FROM items a JOIN items b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n) GROUP BY 1, 2),
links AS (SELECT x, y FROM common WHERE 100 * c >= 75 * (nx + ny - c)),
edges AS (SELECT x AS a, y AS b FROM links UNION ALL SELECT y, x FROM links),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, CAST(least(s.doc_id, coalesce(m.b, s.doc_id)) AS BIGINT) AS component_id
FROM sets s LEFT JOIN (SELECT a, min(b) AS b FROM reach GROUP BY a) m ON m.a = s.doc_id
"""

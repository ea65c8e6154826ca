"""Sharding by a hierarchical weighted hash tree: region, rack and shard by weighted draws of the document id.

At each level every child makes one exponential draw, ``-ln(u) / weight``, from the MD5 of (key, child), where a child's weight is
the sum of the weights of its leaves, and the document descends to the child with the least draw; so each node is chosen in
proportion to its weight, and only the children on the path are drawn.  When a weight changes, only draws of that leaf, its rack
and its region change: documents move between that subtree and others, or inside it, and nowhere else.  New shards open a
subtree of their own once the last rack is full, so at full racks one more shard takes documents only into itself.

Law: ``key`` (doc_id and the number of shards decide).  With 24 shards the tree has three full regions of two racks of four; the 25th opens
a fourth region, whose draw is a new one beside three that stay, so documents move only into it.

Where the last rack is not full, one more shard raises the weight of its rack and region too, and documents come into that subtree and
may move inside the subtree's racks: into the changed rack, and in it into the new shard only.

Defined results: null ids hash as the text ``null``; null texts have no bytes (size 8, CRC-32 of nothing, 0); repeated rows go to
the same shard and get slots of their own; ties of a draw go to the lowest child; an empty table gives an empty table.
Slots are numbered without gathering a shard in one task (see :func:`tessera.llm.common.numbered`).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, numbered

SHARDS, RACK_SHARDS, REGION_RACKS = 24, 4, 2


@dataclass(frozen=True)
class Leaf:
    """A shard with its place in the tree."""

    region: int
    rack: int
    shard: int
    weight: float = 1.0


def tree(shards: int, rack_shards: int = RACK_SHARDS, region_racks: int = REGION_RACKS) -> list[Leaf]:
    """Leaves of equal weight; racks and regions fill up in order, so one more shard keeps all others in place."""
    return [Leaf(s // (rack_shards * region_racks), s // rack_shards, s) for s in range(shards)]


def _draw(key: Column, name: str, weight: float) -> Column:
    """The exponential draw of the child ``name``; the order of equal weights is that of the hashes."""
    value = F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{name}")).cast("binary")), 1, 12), 16, 10).cast("double")
    return -F.log((F.lit(float(2**48)) - value) / float(2**48 + 1)) / F.lit(weight)


def _least(key: Column, children: list[tuple[str, float, int]]) -> Column:
    """The number of the child (name, weight, number) with the least draw."""
    if len(children) == 1:
        return F.lit(children[0][2])
    return F.array_min(F.array(*[F.struct(_draw(key, name, weight).alias("draw"), F.lit(number).alias("number")) for name, weight, number in children]))["number"]


def _chosen(at: Column, choices: dict[int, Column]) -> Column:
    out = F.lit(None).cast("int")
    for number, value in choices.items():
        out = F.when(at == number, value).otherwise(out)
    return out


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def descend(key: Column, leaves: list[Leaf]) -> Column:
    """Struct (region, rack, shard) of the leaf that ``key`` reaches: one draw for each child on the path."""
    regions: dict[int, dict[int, list[Leaf]]] = {}
    for x in leaves:
        regions.setdefault(x.region, {}).setdefault(x.rack, []).append(x)
    of_rack = lambda rack: sum(x.weight for x in rack)
    region = _least(key, [(f"r{r}", sum(map(of_rack, racks.values())), r) for r, racks in sorted(regions.items())])
    rack = lambda at: _chosen(at, {r: _least(key, [(f"k{k}", of_rack(own), k) for k, own in sorted(racks.items())]) for r, racks in regions.items()})
    shard = lambda at: _chosen(at, {k: _least(key, [(f"s{x.shard}", x.weight, x.shard) for x in own]) for racks in regions.values() for k, own in racks.items()})
    whole = lambda r: _let(rack(r), lambda k: F.struct(r.alias("region"), k.alias("rack"), shard(k).alias("shard")))
    return _let(region, whole)


def assign_shards(docs: DataFrame, leaves: list[Leaf], key_col: str = "doc_id", out_col: str = "shard") -> DataFrame:
    """``docs`` with ``out_col``, the shard of each row; an existing column of that name is replaced."""
    return docs.withColumn(out_col, descend(F.coalesce(F.col(key_col).cast("string"), F.lit("null")), leaves)["shard"])


def sharded(docs: DataFrame, shards: int = SHARDS, spread: int = 256) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, region and rack of every row.

    ``spread`` cuts each shard into so many sub-groups, by the id's hash, for the numbering of slots.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        descend(key, tree(shards)).alias("place"),
        descend(key, tree(shards + 1))["shard"].alias("grown_shard"),
        F.pmod(F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(spread)).alias("_sub"),
    )
    rows = materialize(rows.select("*", "place.shard", "place.region", "place.rack").drop("place"), "shards")
    placed = numbered(rows, "shard", "_sub", ["doc_id", "text_crc32", "size"], "slot")
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard", "region", "rack")


ORACLE_SQL = f"""
WITH RECURSIVE base AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(strlen(text), 0) + 8 AS size, coalesce(CAST(doc_id AS VARCHAR), 'null') AS k FROM documents),
step(i, n, c) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL
  SELECT i, n + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END FROM step WHERE n < 8),
crc AS (SELECT list(c ORDER BY i) AS tbl FROM step WHERE n = 8),
texts AS (SELECT DISTINCT t, hex(encode(t)) AS h FROM base),
sums AS (
  SELECT t, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(0, strlen(t)), lambda j: CAST('0x' || substr(h, CAST(2 * j + 1 AS BIGINT), 2) AS BIGINT))),
    lambda c, b: xor(tbl[1 + (xor(c, b) & 255)], c >> 8)), CAST(4294967295 AS BIGINT)) AS text_crc32 FROM texts, crc),
ids AS (SELECT DISTINCT k FROM base),
leaves AS (SELECT n, s, s // {RACK_SHARDS * REGION_RACKS} AS r, s // {RACK_SHARDS} AS k FROM (VALUES ({SHARDS}), ({SHARDS + 1})) t(n), range({SHARDS + 1}) leaf(s) WHERE s < n),
region AS (
  SELECT k, n, arg_min(r, -ln((281474976710656.0::DOUBLE - CAST('0x' || substr(md5(k || ':r' || r), 1, 12) AS BIGINT)) / 281474976710657.0::DOUBLE) / w) AS r
  FROM ids, (SELECT n, r, count(*)::DOUBLE AS w FROM leaves GROUP BY n, r) GROUP BY k, n),
rack AS (
  SELECT k, n, r, arg_min(c, -ln((281474976710656.0::DOUBLE - CAST('0x' || substr(md5(k || ':k' || c), 1, 12) AS BIGINT)) / 281474976710657.0::DOUBLE) / w) AS c
  FROM region JOIN (SELECT n, r, k AS c, count(*)::DOUBLE AS w FROM leaves GROUP BY ALL) USING (n, r) GROUP BY k, n, r),
reached AS (
  SELECT k, n, r, c, arg_min(s, CAST('0x' || substr(md5(k || ':s' || s), 1, 12) AS BIGINT)) AS s FROM rack JOIN (SELECT n, k AS c, s FROM leaves) USING (n, c) GROUP BY k, n, r, c),
best AS (SELECT a.k, CAST(a.s AS INTEGER) AS shard, CAST(b.s AS INTEGER) AS grown_shard, CAST(a.r AS INTEGER) AS region, CAST(a.c AS INTEGER) AS rack FROM reached a JOIN reached b USING (k) WHERE a.n = {SHARDS} AND b.n = {SHARDS + 1})
SELECT b.doc_id, CAST(b.size AS BIGINT) AS size, CAST(c.text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, g.shard, g.grown_shard, g.region, g.rack,
  CAST(row_number() OVER (PARTITION BY g.shard ORDER BY CAST('0x' || substr(md5(b.k), 1, 8) AS BIGINT) % 256, b.doc_id NULLS FIRST, c.text_crc32, b.size) - 1 AS BIGINT) AS slot
FROM base b JOIN best g USING (k) JOIN sums c USING (t)
"""

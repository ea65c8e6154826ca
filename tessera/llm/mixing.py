"""Mixing sources to target weights by Pfair scheduling, with DataFrame functions only.

The rows of each source, in the order of their id's hash, form blocks of ``block_rows``.  With weight w, block k (from 0) of a
source is released at slot floor(k / w) and due by slot ceil((k + 1) / w); each slot goes to the released block with the earliest
deadline.  As the weights are whole shares of a period of ``period`` slots, one period is scheduled (a fold over its slots inside a single
row) and repeats: block k of a source with ``a`` slots in the period stands in period k div a, at that source's (k mod a)-th slot.
So long as no source has run out, each has had less than one block more or less than its weight of the slots so far.  When a source
runs out, its slots stay empty and the others keep their order, so no row is dropped or repeated.

Target weights: ``weights`` by source, or the row counts to the power ``alpha`` (0.5 by default).  Shares are whole slots by
largest remainder, at least one each; the period grows to four slots a source if it is shorter than that.

Defined results: a null source is a source of its own; null ids hash as the text ``null``; ties are ordered by all other columns
that sort; repeated rows each keep a place; an empty table gives an empty table; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names, numbered

PERIOD, BLOCK_ROWS, ALPHA, SPREAD = 1000, 32, 0.5, 256


def source_shares(docs: DataFrame, weights: dict[str, float] | None = None, period: int = PERIOD, alpha: float = ALPHA, source_col: str = "source") -> DataFrame:
    """One row with ``shares``: the array of (rank, source, n_rows, share), sources in order, and ``period``: the shares' sum.

    ``weights`` must hold every source of the table; a source without weight counts as weight 0 and gets one slot.
    """
    counts = docs.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("n_rows"))
    if weights is None:
        target = F.pow(F.col("n_rows").cast("double"), F.lit(alpha))
    else:
        given = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else F.create_map().cast("map<string,double>")
        target = F.coalesce(F.try_element_at(given, F.coalesce(F.col("source"), F.lit(""))).cast("double"), F.lit(0.0))
    one = counts.select("source", "n_rows", target.alias("target")).agg(F.sort_array(F.collect_list(F.struct("source", "n_rows", "target"))).alias("s")).where(F.size("s") > 0)
    one = one.withColumn("period", F.greatest(F.lit(period), 4 * F.size("s")))
    # Every source has one slot; the others go by largest remainder of the weight, ties to the earlier source.
    one = one.withColumn("total", F.aggregate("s", F.lit(0.0), lambda a, x: a + x["target"]))
    one = one.withColumn("free", F.col("period") - F.size("s"))
    exact = F.transform("s", lambda x, i: F.struct(i.alias("rank"), x["source"].alias("source"), x["n_rows"].alias("n_rows"), F.when(F.col("total") > 0, x["target"] / F.col("total")).otherwise(F.lit(1.0) / F.size("s")).alias("w")))
    one = one.withColumn("e", exact)
    one = one.withColumn("e", F.transform("e", lambda x: F.struct(x["rank"].alias("rank"), x["source"].alias("source"), x["n_rows"].alias("n_rows"), F.floor(x["w"] * F.col("free")).cast("int").alias("whole"), F.round(x["w"] * F.col("free") - F.floor(x["w"] * F.col("free")), 9).alias("part"))))
    one = one.withColumn("left", F.col("free") - F.aggregate("e", F.lit(0), lambda a, x: a + x["whole"]))
    ranked = F.array_sort("e", lambda a, b: F.when(a["part"] > b["part"], -1).when(a["part"] < b["part"], 1).otherwise(a["rank"] - b["rank"]))
    one = one.withColumn("up", F.transform(F.slice(ranked, F.lit(1), F.col("left")), lambda x: x["rank"]))
    shares = F.transform("e", lambda x: F.struct(x["rank"].alias("rank"), x["source"].alias("source"), x["n_rows"].alias("n_rows"), (1 + x["whole"] + F.array_contains("up", x["rank"]).cast("int")).alias("share")))
    return one.select(shares.alias("shares"), "period")


def _due(done: Column, share: Column, period: Column) -> Column:
    """ceil((done + 1) * period / share), the deadline of the next block."""
    return F.floor(((done + 1) * period + share - 1) / share).cast("int")


def _released(done: Column, share: Column, period: Column) -> Column:
    return F.floor(done * period / share).cast("int")


def period_slots(shares: DataFrame) -> DataFrame:
    """(source, share, period, turn, offset): the slot of each turn of each source within one period; ``period`` rows.

    Earliest deadline first: a fold over the slots keeps the number of blocks each source has had.
    """

    def step(state: Column, slot: Column) -> Column:
        ready = F.filter(F.col("shares"), lambda x: (_released(F.get(state["done"], x["rank"]), x["share"], F.col("period")) <= slot) & (F.get(state["done"], x["rank"]) < x["share"]))
        first = F.array_min(F.transform(ready, lambda x: F.struct(_due(F.get(state["done"], x["rank"]), x["share"], F.col("period")).alias("due"), x["rank"].alias("rank"))))["rank"]
        return F.struct(
            F.transform(state["done"], lambda n, i: n + (i == F.coalesce(first, F.lit(-1))).cast("int")).alias("done"),
            F.concat(state["order"], F.array(F.coalesce(first, F.lit(-1)))).alias("order"),
        )

    start = F.struct(F.transform("shares", lambda _: F.lit(0)).alias("done"), F.array().cast("array<int>").alias("order"))
    ran = shares.withColumn("order", F.aggregate(F.sequence(F.lit(0), F.col("period") - 1), start, step)["order"])
    each = ran.select("period", F.explode("shares").alias("s"), "order")
    at = F.filter(F.transform("order", lambda r, i: F.when(r == F.col("s.rank"), i)), lambda x: x.isNotNull())
    return each.select("period", F.col("s.source").alias("source"), F.col("s.share").alias("share"), at.alias("offsets")).select("source", "share", "period", F.posexplode("offsets").alias("turn", "offset"))


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, block_rows: int = BLOCK_ROWS, period: int = PERIOD, alpha: float = ALPHA, source_col: str = "source", id_col: str = "doc_id", spread: int = SPREAD) -> DataFrame:
    """``docs`` with ``mix_block``, ``mix_slot``, ``mix_release``, ``mix_due`` and ``mix_row``: read in the order (mix_slot, mix_row).

    Columns of those names are replaced.  ``spread`` cuts each source, for the numbering of its rows, into so many sub-groups.
    """
    made = ["mix_block", "mix_slot", "mix_release", "mix_due", "mix_row"]
    docs = docs.drop(*made)
    names = free_names([*docs.columns, *made], "_hash", "_sub", "_rank", "_turn", "_s", "_share", "_period", "_s2", "_share2", "_period2", "_turn2", "_offset")
    hash_, sub, rank, turn, s1, share1, period1, s2, share2, period2, turn2, offset = names
    # Bounded: one row for each slot of one period.
    slots = F.broadcast(period_slots(source_shares(docs, weights, period, alpha, source_col)).select(F.col("source").alias(s2), F.col("share").alias(share2), F.col("period").alias(period2), F.col("turn").alias(turn2), F.col("offset").alias(offset)))
    hashed = docs.withColumn(hash_, F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).cast("binary")))
    hashed = hashed.withColumn(sub, F.pmod(F.conv(F.substring(hash_, 1, 6), 16, 10).cast("long"), F.lit(spread)))
    ties = [f.name for f in docs.schema.fields if f.name != source_col and f.dataType.typeName() in ("string", "long", "integer", "double", "boolean", "date", "timestamp")]
    ranked = numbered(hashed, source_col, sub, [hash_, *ties], rank)
    ranked = ranked.withColumn("mix_block", F.floor(F.col(rank) / block_rows).cast("long")).withColumn("mix_row", F.pmod(rank, F.lit(block_rows)).cast("int"))
    # One row of shares a source, then the slot of the turn: two broadcasts of at most one period.
    share = slots.where(F.col(turn2) == 0).select(F.col(s2).alias(s1), F.col(share2).alias(share1), F.col(period2).alias(period1))
    ranked = ranked.join(F.broadcast(share), F.col(source_col).eqNullSafe(F.col(s1)), "left")
    ranked = ranked.withColumn(turn, F.pmod("mix_block", F.col(share1)).cast("int"))
    placed = ranked.join(slots, F.col(source_col).eqNullSafe(F.col(s2)) & (F.col(turn) == F.col(turn2)), "left")
    placed = placed.withColumn("mix_slot", (F.floor(F.col("mix_block") / F.col(share1)) * F.col(period1) + F.col(offset)).cast("long"))
    placed = placed.withColumn("mix_release", F.floor(F.col("mix_block") * F.col(period1) / F.col(share1)).cast("long"))
    placed = placed.withColumn("mix_due", F.floor(((F.col("mix_block") + 1) * F.col(period1) + F.col(share1) - 1) / F.col(share1)).cast("long"))
    return placed.select(*docs.columns, *made)


def mixed_order(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` with its own columns only, globally sorted into the mix (range partitions, so by many tasks).

    Texts move twice: to be numbered within their source and to their range of the mix.
    """
    renamed = dict(zip(docs.columns, free_names(["mix_block", "mix_slot", "mix_release", "mix_due", "mix_row"], *docs.columns), strict=True))
    mixed = mix_sources(docs.withColumnsRenamed(renamed), **options).orderBy("mix_slot", "mix_row")
    return mixed.select(*[F.col(new).alias(old) for old, new in renamed.items()])


def mix_digest(docs: DataFrame) -> DataFrame:
    """doc_id, source and the mix columns: the digest form of :func:`mix_sources`."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"))
    return mix_sources(rows)


#: DuckDB: shares by largest remainder, one period slot by slot by earliest deadline, and each row's place by its number within its source.
ORACLE_SQL = r"""
WITH RECURSIVE counts AS (SELECT source, count(*) AS n_rows FROM documents GROUP BY source),
ranked AS (SELECT source, sqrt(CAST(n_rows AS DOUBLE)) AS target, row_number() OVER (ORDER BY source NULLS FIRST) AS r FROM counts),
whole AS (SELECT list_sum(list(target ORDER BY r)) AS total, count(*) AS k, greatest(1000, 4 * count(*)) AS period FROM ranked),
exact AS (SELECT source, r, period, period - k AS free, target / total * (period - k) AS x FROM ranked, whole),
parts AS (SELECT *, row_number() OVER (ORDER BY round(x - floor(x), 9) DESC, r) AS place, free - sum(CAST(floor(x) AS BIGINT)) OVER () AS left_over FROM exact),
shares AS (SELECT source, r, period, CAST(1 + CAST(floor(x) AS BIGINT) + CAST(place <= left_over AS BIGINT) AS BIGINT) AS share FROM parts),
one AS (SELECT list(share ORDER BY r) AS s, any_value(period) AS period FROM shares HAVING count(*) > 0),
run AS (
  SELECT CAST(-1 AS BIGINT) AS t, CAST(0 AS BIGINT) AS pick, list_transform(s, lambda a: CAST(0 AS BIGINT)) AS done FROM one
  UNION ALL
  SELECT t + 1, pick2, list_transform(done, lambda d, i: d + CAST(i = pick2 AS BIGINT)) FROM (
    SELECT t, done, list_min(list_transform(
      list_filter(range(1, CAST(len(s) + 1 AS BIGINT)), lambda i: done[i] < s[i] AND done[i] * period // s[i] <= t + 1),
      lambda i: {'due': ((done[i] + 1) * period + s[i] - 1) // s[i], 'r': i})).r AS pick2
    FROM run, one WHERE t + 1 < period)),
slots AS (SELECT pick AS r, t AS "offset", row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS turn FROM run WHERE t >= 0 AND pick IS NOT NULL),
hashed AS (SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents),
placed AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY CAST('0x' || substr(h, 5, 2) AS INTEGER), h, doc_id NULLS FIRST) - 1 AS n FROM hashed),
blocks AS (SELECT p.doc_id, p.source, p.n // 32 AS b, p.n % 32 AS m, s.r, s.share, s.period FROM placed p JOIN shares s ON p.source IS NOT DISTINCT FROM s.source)
SELECT b.doc_id, b.source, CAST(b.b AS BIGINT) AS mix_block, CAST(b.b // b.share * b.period + s."offset" AS BIGINT) AS mix_slot,
  CAST(b.b * b.period // b.share AS BIGINT) AS mix_release, CAST(((b.b + 1) * b.period + b.share - 1) // b.share AS BIGINT) AS mix_due, CAST(b.m AS INTEGER) AS mix_row
FROM blocks b LEFT JOIN slots s ON s.r = b.r AND s.turn = b.b % b.share
"""

"""Entity matching: exact, aliased, overridden, unique-name and fuzzy levels, with every tie decided by an explicit rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import accent_name, loose_name, match_name, plain_name
from ..functions.similarity import length_bound, seq_ratio
from .cut import cut

#: Fixed values.
FUZZY_CUTOFF, POOL_THRESHOLD, ESCALATE_BELOW = 0.85, 0.75, 0.85


def match_cascade(entities: DataFrame, panel: DataFrame, aliases: dict[str, str], overrides: dict[str, str], normal=plain_name, loose=match_name) -> DataFrame:
    """``entities`` (code, name, province) with level and panel_idx of the panel row (name, province, idx) each matches.

    Levels: exact (name and province), fuzzy (looser names, province alias), manual (the code's override, if that name is in the
    panel), name_only (a looser name that is unique in the panel), else unmatched.  Of panel rows with one key the last counts.
    Aliases and overrides are literals, so only the panel's four keyed views are joined.
    """
    named = panel.select("idx", "name", F.coalesce("province", F.lit("")).alias("province"))
    keyed = named.select("idx", "name", normal(F.col("name")).alias("k_name"), normal(F.col("province")).alias("k_prov"), loose(F.col("name")).alias("l_name"), loose(F.col("province")).alias("l_prov"))
    exact = keyed.groupBy("k_name", "k_prov").agg(F.max("idx").alias("exact_idx"))
    near = keyed.groupBy("l_name", "l_prov").agg(F.max("idx").alias("near_idx"))
    raw = keyed.groupBy(F.col("name").alias("override")).agg(F.max("idx").alias("manual_idx"))
    unique = keyed.groupBy("l_name").agg(F.count(F.lit(1)).alias("_n"), F.max("idx").alias("unique_idx")).where("_n = 1").drop("_n")

    def mapped(pairs: dict[str, str], key: Column) -> Column:
        return F.try_element_at(F.create_map(*[F.lit(x) for p in pairs.items() for x in p]), key) if pairs else F.lit(None).cast("string")

    province = F.coalesce("province", F.lit(""))
    e = entities.select(
        "code", "name", "province",
        normal(F.col("name")).alias("k_name"), normal(province).alias("k_prov"),
        loose(F.col("name")).alias("l_name"), loose(F.coalesce(mapped(aliases, province), province)).alias("l_prov"),
        mapped(overrides, F.col("code").cast("string")).alias("override"),
    )
    found = e.join(exact, ["k_name", "k_prov"], "left").join(near, ["l_name", "l_prov"], "left").join(raw, "override", "left").join(unique, "l_name", "left")
    level = F.when(F.col("exact_idx").isNotNull(), "exact").when(F.col("near_idx").isNotNull(), "fuzzy").when(F.col("manual_idx").isNotNull(), "manual").when(F.col("unique_idx").isNotNull(), "name_only").otherwise("unmatched")
    return found.select("code", "name", "province", level.alias("level"), F.coalesce("exact_idx", "near_idx", "manual_idx", "unique_idx").alias("panel_idx"))


def exact_match(rows: DataFrame, panel: DataFrame, keys: list[str], first: bool = True) -> DataFrame:
    """Each row with the idx of the first (or last) panel row of equal keys, else null."""
    pick = F.min("idx") if first else F.max("idx")
    return rows.join(panel.groupBy(*keys).agg(pick.alias("panel_idx")), keys, "left")


def _pieces(word: Column, cutoff: float) -> Column:
    """(text, place, slack): a word cut into one piece more than a ratio of ``cutoff`` leaves letters unmatched, so one piece is whole in any match."""
    n = F.length(word)
    slack = F.floor(F.lit(round(2 * (1 - cutoff) / cutoff, 9)) * n).cast("int")
    count = F.least(slack + 1, n)
    size = F.floor(n / count).cast("int")
    longer = (n - size * count).cast("int")

    def piece(i: Column) -> Column:
        start = i * size + F.least(i, longer)
        return F.struct(F.substr(word, start + 1, size + F.when(i < longer, 1).otherwise(0)).alias("piece"), start.alias("place"), slack.alias("slack"))

    return F.when(n > 0, F.transform(F.sequence(F.lit(0), count - 1), piece))


def _grams(word: Column, longest: int) -> Column:
    """(piece, place) of all substrings of up to ``longest`` letters."""
    n = F.length(word)
    of = lambda k: F.when(n >= k, F.transform(F.sequence(F.lit(0), n - k), lambda i: F.struct(F.substr(word, i + 1, F.lit(k)).alias("piece"), i.alias("place")))).otherwise(F.array().cast("array<struct<piece:string,place:int>>"))
    return F.flatten(F.array(*[of(k) for k in range(1, longest + 1)]))


def fuzzy_candidates(words: DataFrame, panel: DataFrame, cutoff: float = FUZZY_CUTOFF, block: list[str] = ()) -> DataFrame:
    """Pairs (block..., word, name) whose ratio may reach ``cutoff``: none that does is missing.

    A ratio r of words of n letters leaves at most 2 n (1 - r) / r letters of both unmatched, and each breaks at most one piece of a
    word, so with one piece more some piece stands whole in the other word, not further off than that.  An equi-join on pieces
    thus replaces the product of all words; the length bound prunes before the ratio itself.
    """
    longest = max(1, -(-1 // (2 * (1 - cutoff) / cutoff)) if cutoff < 1 else 1)
    longest = int(longest) + 1
    left = words.select(*block, "word").distinct().select(*block, "word", F.inline(_pieces(F.col("word"), cutoff)))
    left = left.withColumnRenamed("place", "w_place")
    right = panel.select(*block, "name").distinct().select(*block, "name", F.inline(_grams(F.col("name"), longest)))
    pairs = left.join(right, [*block, "piece"]).where((F.abs(F.col("place") - F.col("w_place")) <= F.col("slack")) & (length_bound(F.col("word"), F.col("name")) >= cutoff))
    return pairs.select(*block, "word", "name").distinct()


def fuzzy_f1(words: DataFrame, panel: DataFrame, cutoff: float = FUZZY_CUTOFF, block: list[str] = ()) -> DataFrame:
    """(block..., word, name, score): the panel name with the highest ratio to each word, ties to the largest name."""
    scored = fuzzy_candidates(words, panel, cutoff, block).withColumn("score", seq_ratio(F.col("name"), F.col("word"))).where(F.col("score") >= cutoff)
    return scored.groupBy(*block, "word").agg(F.max(F.struct("score", "name")).alias("m")).select(*block, "word", F.col("m.name").alias("name"), F.col("m.score").alias("score"))


def link_names(rows: DataFrame, panel: DataFrame, cutoff: float = FUZZY_CUTOFF) -> DataFrame:
    """``rows`` (row_id, province, norm) with name_status and panel_idx.

    Exact then fuzzy in the row's province; what is left, and rows without a province in the panel, exact then fuzzy in the whole panel.  Of panel
    rows (idx, province, norm) with one name the first counts.  Distinct names are linked, and only what a stage leaves open reaches the next.
    """
    named = panel.select("idx", "province", "norm")
    first_here = named.where("province is not null").groupBy("province", "norm").agg(F.min("idx").alias("here"))
    first_any = named.groupBy("norm").agg(F.min("idx").alias("anywhere"))
    asked = cut(rows.select("province", "norm").distinct().join(first_here, ["province", "norm"], "left"))
    open_here = asked.where("here is null and province is not null").select("province", F.col("norm").alias("word"))
    near = fuzzy_f1(open_here, first_here.select("province", F.col("norm").alias("name")), cutoff, ["province"])
    near = near.join(first_here.select("province", F.col("norm").alias("name"), F.col("here").alias("near_here")), ["province", "name"]).select("province", F.col("word").alias("norm"), "near_here")
    asked = cut(asked.join(near, ["province", "norm"], "left").join(first_any, "norm", "left"))
    still_open = asked.where("here is null and near_here is null and anywhere is null").select(F.col("norm").alias("word"))
    far = fuzzy_f1(still_open, first_any.select(F.col("norm").alias("name")), cutoff)
    far = far.join(first_any.select(F.col("norm").alias("name"), F.col("anywhere").alias("near_any")), "name").select(F.col("word").alias("norm"), "near_any")
    found = asked.join(far, "norm", "left")
    status = F.when(F.col("here").isNotNull(), "exact").when(F.col("near_here").isNotNull(), "fuzzy").when(F.col("anywhere").isNotNull(), "exact").when(F.col("near_any").isNotNull(), "fuzzy").otherwise("no_ref")
    found = found.select(F.col("province").alias("_p"), F.col("norm").alias("_n"), status.alias("name_status"), F.coalesce("here", "near_here", "anywhere", "near_any").alias("panel_idx"))
    return rows.join(found, F.col("province").eqNullSafe(F.col("_p")) & F.col("norm").eqNullSafe(F.col("_n")), "left").select("row_id", "name_status", "panel_idx")


def length_pairs(words: DataFrame, panel: DataFrame, cutoff: float = FUZZY_CUTOFF) -> DataFrame:
    """Distinct pairs (word, name) whose lengths allow a ratio of ``cutoff``: an equi-join on the name lengths that a word can match."""
    n, reach = F.length("word"), (2 - cutoff) / cutoff
    left = words.select("word").distinct().select("word", F.explode(F.sequence(F.floor(n / reach), F.ceil(n * reach))).alias("_m"))
    right = panel.select("name").distinct().withColumn("_m", F.length("name").cast("long"))
    return left.join(right, "_m").where(length_bound(F.col("word"), F.col("name")) >= cutoff).select("word", "name")


def region_pool(regions: DataFrame, panel: DataFrame, provinces: dict[str, list[str]]) -> DataFrame:
    """(region, name, idx): panel names of the region, or of panel regions that contain one of its provinces' names.

    A region without any has no rows here: its pool is the whole panel, which the second stage of :func:`link_regions` scores once for
    all such regions.  The theta join is between distinct region names of both sides, so it is as small as they are.
    """
    known = panel.select("region").where("region is not null").distinct()
    listed = F.create_map(*[F.lit(x) if isinstance(x, str) else F.array(*[F.lit(y) for y in x]) for pair in provinces.items() for x in pair])
    asked = regions.select(F.col("region").alias("asked")).distinct().withColumn("its", F.coalesce(F.try_element_at(listed, F.col("asked")), F.array().cast("array<string>")))
    hit = (F.col("region") == F.col("asked")) | F.exists("its", lambda p: F.contains(F.lower("region"), F.lower(p)))
    return asked.join(known, hit).select("asked", "region").join(panel.select("region", "name", "idx"), "region").select(F.col("asked").alias("region"), "name", "idx")


def fuzzy_f2(words: DataFrame, pool: DataFrame, block: list[str] = (), threshold: float = POOL_THRESHOLD, sure: float = FUZZY_CUTOFF) -> DataFrame:
    """(block..., word, name, score): highest ratio in the pool, ties to the least idx; no name under ``threshold``, but its score.

    Words with a ratio of ``sure`` or more are settled by the equi-join on pieces, which loses no such pair.  Only the others are scored against
    every name of their pool, since the score of what fails is part of the result.  Spark broadcasts a pool only if it finds it small.
    """
    by = list(block)
    asked = words.select(*by, "word").distinct()
    names = pool.groupBy(*by, "name").agg(F.min("idx").alias("idx"))

    def best(pairs: DataFrame) -> DataFrame:
        scored = pairs.withColumn("score", seq_ratio(F.col("word"), F.col("name")))
        return scored.groupBy(*by, "word").agg(F.max(F.struct("score", (-F.col("idx")).alias("order"), "name")).alias("m"))

    near = fuzzy_candidates(asked, names, sure, by).join(names, [*by, "name"])
    settled = cut(best(near).where(F.col("m.score") >= sure))
    open_ = asked.join(settled.select(*by, "word"), [*by, "word"], "left_anti")
    rest = best(open_.join(names, by) if by else open_.crossJoin(names))
    return settled.unionByName(rest).select(*by, "word", F.when(F.col("m.score") >= threshold, F.col("m.name")).alias("name"), F.col("m.score").alias("score"))


def link_regions(rows: DataFrame, panel: DataFrame, provinces: dict[str, list[str]], accept: float = ESCALATE_BELOW) -> DataFrame:
    """``rows`` (row_id, region, norm) with match_type, name and score: exact anywhere, else the region's best, else (if under
    ``accept``) the whole panel's if strictly better; accepted from ``accept`` on.  ``panel`` has idx, region, norm; names stand in the order of their first rows."""
    names = panel.groupBy("norm").agg(F.min("idx").alias("idx"))
    exact = rows.join(names.select("norm", F.col("norm").alias("hit")), "norm", "left")
    done = exact.where("hit is not null").select("row_id", F.lit("exact").alias("match_type"), F.col("hit").alias("name"), F.lit(1.0).alias("score"))
    left = exact.where("hit is null").drop("hit")
    pool = region_pool(left.select("region"), panel.select("region", F.col("norm").alias("name"), "idx"), provinces)
    here = fuzzy_f2(left.select("region", F.col("norm").alias("word")), pool, ["region"]).withColumnRenamed("word", "norm")
    placed = cut(left.join(here, ["region", "norm"], "left"))
    poor = placed.where(F.coalesce("score", F.lit(0.0)) < accept)
    anywhere = fuzzy_f2(poor.select(F.col("norm").alias("word")), names.select(F.col("norm").alias("name"), "idx")).select(F.col("word").alias("norm"), F.col("name").alias("any_name"), F.col("score").alias("any_score"))
    both = placed.join(anywhere, "norm", "left")
    better = (F.coalesce("score", F.lit(0.0)) < accept) & (F.col("any_score") > F.coalesce("score", F.lit(0.0)))
    both = both.withColumn("best", F.when(better, F.col("any_name")).otherwise(F.col("name"))).withColumn("top", F.when(better, F.col("any_score")).otherwise(F.col("score")))
    good = F.col("best").isNotNull() & (F.col("top") >= accept)
    return done.unionByName(both.select("row_id", F.when(good, "fuzzy").otherwise("none").alias("match_type"), F.when(good, F.col("best")).alias("name"), F.coalesce("top", F.lit(0.0)).alias("score")))


def reconcile(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, side): matched, left_only or right_only, for the distinct keys of both sides."""
    a = left.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_l", F.lit(True))
    b = right.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_r", F.lit(True))
    side = F.when(F.col("_l") & F.col("_r"), "matched").when(F.col("_l"), "left_only").otherwise("right_only")
    return a.join(b, key, "full_outer").select(key, side.alias("side"))


def level_counts(matched: DataFrame) -> DataFrame:
    """A7."""
    return matched.groupBy("level").agg(F.count(F.lit(1)).alias("n"))


__all__ = ["accent_name", "exact_match", "fuzzy_candidates", "fuzzy_f1", "fuzzy_f2", "length_pairs", "level_counts", "link_names", "link_regions", "loose_name", "match_cascade", "reconcile", "region_pool"]

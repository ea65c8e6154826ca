"""Code lineage: bridges by a shared key, closure of successions, the forward cascade, its inversion and classification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import plain_name, province_prefix
from .cut import cut

#: Fixed values.
METHODS = ("DIRECT", "CATASTALE", "SISTAT", "LOST_TERRITORY", "ANPR_FALLBACK", "UNTRACED")
LOST_PREFIXES = ("701", "702", "703", "801", "802")
MAX_DEPTH = 10
TRANSFER_EVENTS = ("territory_acquisition", "territory_cession")


def key_bridge(codes: DataFrame, ref: DataFrame) -> DataFrame:
    """(code, dest): other codes of a shared key to its one reference code.

    ``codes`` has code, key and idx (load order); keys that are null or empty bridge nothing, nor do keys with more than one
    reference code.  A code with several such keys takes that of the key seen first.
    """
    known = codes.where(F.col("key").isNotNull() & (F.col("key") != "")).groupBy("key", "code").agg(F.min("idx").alias("idx"))
    flagged = known.join(ref.select(F.col("code"), F.lit(True).alias("is_ref")).distinct(), "code", "left")
    single = flagged.groupBy("key").agg(F.count(F.when(F.col("is_ref"), 1)).alias("n_ref"), F.max(F.when(F.col("is_ref"), F.col("code"))).alias("dest"), F.min("idx").alias("first_idx")).where("n_ref = 1")
    mapped = flagged.where(F.col("is_ref").isNull()).join(single, "key")
    return mapped.groupBy("code").agg(F.min_by("dest", "first_idx").alias("dest"))


def closure(edges: DataFrame, ref: DataFrame, depth: int = MAX_DEPTH) -> DataFrame:
    """(code, dest): reference codes reached from each other code by at most ``depth`` edges through other codes.

    Reference codes absorb.  One join a level, each on what the last level found new, so cycles end and work is bounded by the pairs
    reached.  Each level is written once, to the checkpoint folder; where none is set, it is cached.
    """
    steps = edges.where("src is not null and dst is not null and src <> '' and dst <> ''" if dict(edges.dtypes)["src"] == "string" else "src is not null and dst is not null").select("src", "dst").distinct()
    ends = ref.select(F.col("code").alias("dst")).distinct().withColumn("absorbs", F.lit(True))
    steps = steps.join(ends.withColumnRenamed("dst", "src").drop("absorbs"), "src", "left_anti").join(ends, "dst", "left").select("src", "dst", F.coalesce("absorbs", F.lit(False)).alias("absorbs"))
    steps = cut(steps)
    reached = frontier = steps.select(F.col("src").alias("code"), F.col("dst").alias("at"), "absorbs")
    for _ in range(depth - 1):
        onward = frontier.where(~F.col("absorbs")).select("code", F.col("at").alias("src")).join(steps, "src").select("code", F.col("dst").alias("at"), "absorbs").distinct()
        frontier = onward.join(reached.select("code", "at"), ["code", "at"], "left_anti")
        frontier = cut(frontier)
        if frontier.isEmpty():
            break
        reached = reached.unionByName(frontier)
    return reached.where("absorbs").select("code", F.col("at").alias("dest")).distinct()


def fallback(registry: DataFrame, ref: DataFrame, bridge: DataFrame) -> DataFrame:
    """(code, dest): by the key of the code's first registry row (direct or bridged, least code), else by its province and name.

    ``registry`` has code, key, name and idx.
    """
    first = registry.groupBy("code").agg(F.min_by(F.struct("key", "name"), "idx").alias("r")).select("code", F.coalesce("r.key", F.lit("")).alias("key"), F.coalesce("r.name", F.lit("")).alias("name"))
    in_ref = ref.select("code").distinct()
    of_key = registry.where("key is not null and key <> ''").select("key", F.col("code").alias("other")).distinct()
    direct = of_key.join(in_ref.withColumnRenamed("code", "other"), "other").select("key", F.col("other").alias("hit"))
    bridged = of_key.join(bridge.withColumnRenamed("code", "other"), "other").select("key", F.col("dest").alias("hit"))
    by_key = direct.union(bridged).groupBy("key").agg(F.min("hit").alias("key_hit"))
    named = first.withColumn("province", province_prefix(F.col("code"))).withColumn("norm", plain_name(F.col("name")))
    by_name = named.join(in_ref, "code", "left_semi").groupBy("province", "norm").agg(F.min("code").alias("name_hit"))
    found = named.join(by_key, "key", "left").join(by_name, ["province", "norm"], "left")
    return found.select("code", F.coalesce("key_hit", "name_hit").alias("dest")).where("dest is not null")


def forward_mapping(alive: DataFrame, ref: DataFrame, bridge: DataFrame, reach: DataFrame, rescue: DataFrame) -> DataFrame:
    """(label, code, dest, method) of each code alive at each label, by the first rule that holds; dest is a sorted array."""
    many = reach.groupBy("code").agg(F.sort_array(F.collect_set("dest")).alias("_reach"))
    found = (
        alive.select("label", "code")
        .join(ref.select("code", F.lit(True).alias("_ref")).distinct(), "code", "left")
        .join(bridge.select("code", F.col("dest").alias("_bridge")), "code", "left")
        .join(many, "code", "left")
        .join(rescue.select("code", F.col("dest").alias("_rescue")), "code", "left")
    )
    lost = province_prefix(F.col("code")).isin(*LOST_PREFIXES)
    none = F.array().cast("array<string>")
    method = F.when(F.col("_ref"), "DIRECT").when(F.col("_bridge").isNotNull(), "CATASTALE").when(F.col("_reach").isNotNull(), "SISTAT").when(lost, "LOST_TERRITORY").when(F.col("_rescue").isNotNull(), "ANPR_FALLBACK").otherwise("UNTRACED")
    dest = F.when(F.col("_ref"), F.array("code")).when(F.col("_bridge").isNotNull(), F.array("_bridge")).when(F.col("_reach").isNotNull(), F.col("_reach")).when(lost, none).when(F.col("_rescue").isNotNull(), F.array("_rescue")).otherwise(none)
    return cut(found.select("label", "code", dest.alias("dest"), method.alias("method")))


def method_counts(forward: DataFrame) -> DataFrame:
    """A3."""
    return forward.groupBy("label", "method").agg(F.count(F.lit(1)).alias("n"))


def split_children(forward: DataFrame) -> DataFrame:
    """A4: (label, code): destinations of codes with more than one."""
    return forward.where(F.size("dest") > 1).select("label", F.explode("dest").alias("code")).distinct()


def invert(forward: DataFrame, ref: DataFrame) -> DataFrame:
    """(dest, label, src, method) for destinations in the reference."""
    return forward.select("label", F.col("code").alias("src"), "method", F.explode("dest").alias("dest")).join(ref.select(F.col("code").alias("dest")).distinct(), "dest", "left_semi")


def classify(forward: DataFrame, ref: DataFrame, alive: DataFrame, labels: list[str], territory: DataFrame | None = None) -> DataFrame:
    """A5: one row for each reference code: sources and their number by label, reasons, status, type, and whether it can be traced.

    ``traceable_all_years`` tells codes with a source at every label from those that are usable with none.
    """
    base = ref.select("code").distinct()
    sources = invert(forward, ref).groupBy(F.col("dest").alias("code")).pivot("label", labels).agg(
        F.array_join(F.sort_array(F.collect_list("src")), "|").alias("mapping"), F.count("src").alias("n"), F.collect_set("method").alias("methods")
    )
    children = split_children(forward).groupBy("code").pivot("label", labels).agg(F.lit(True).alias("child"))
    living = alive.join(base, "code", "left_semi").groupBy("code").pivot("label", labels).agg(F.lit(True).alias("alive"))
    children = children.select("code", *[F.col(k).alias(f"{k}_child") for k in labels])
    living = living.select("code", *[F.col(k).alias(f"{k}_alive") for k in labels])
    wide = base.join(sources, "code", "left").join(children, "code", "left").join(living, "code", "left")
    n = {k: F.coalesce(F.col(f"{k}_n"), F.lit(0)).cast("long") for k in labels}
    reasons = []
    for k in labels:
        methods = F.coalesce(F.col(f"{k}_methods"), F.array().cast("array<string>"))
        reasons += [
            F.when((n[k] == 0) & F.col(f"{k}_alive"), f"unmapped_{k}"),
            F.when(F.array_contains(methods, "UNTRACED"), f"untraced_{k}"),
            F.when(F.array_contains(methods, "LOST_TERRITORY"), f"lost_territory_{k}"),
            F.when(F.col(f"{k}_child"), f"split_child_{k}"),
        ]
    flagged = wide.join(territory.select("code", F.lit(True).alias("_flag")).distinct(), "code", "left") if territory is not None else wide.withColumn("_flag", F.lit(False))
    reason = F.array_join(F.array_sort(F.array_compact(F.array(*reasons))), "; ")
    several = F.array_max(F.array(*n.values())) > 1
    return flagged.select(
        "code",
        *[F.coalesce(F.col(f"{k}_mapping"), F.lit("")).alias(f"mapping_{k}") for k in labels],
        *[n[k].alias(f"n_constituents_{k}") for k in labels],
        F.when(several, "AGGREGATE").otherwise("DIRECT").alias("mapping_type"),
        F.when(reason == "", "USABLE").otherwise("DISCARD").alias("status"),
        reason.alias("discard_reason"),
        F.coalesce("_flag", F.lit(False)).alias("territory_transfer_flag"),
        (F.array_min(F.array(*n.values())) > 0).alias("traceable_all_years"),
    )


def reason_histogram(classified: DataFrame) -> DataFrame:
    """Discard reasons by their base."""
    from ..functions.names import reason_base

    each = classified.where("status = 'DISCARD'").select(F.explode(F.split("discard_reason", "; ")).alias("r")).where("r <> ''")
    return each.groupBy(reason_base(F.col("r")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def untraced_usable(classified: DataFrame) -> DataFrame:
    """P20: usable rows with an untraced reason; there are none unless something is wrong."""
    return classified.where("status = 'USABLE' and contains(discard_reason, 'untraced')")


def territory_flags(events: DataFrame, entities: DataFrame, counterparts: list[tuple[DataFrame, str]], ref: DataFrame, start: str = "1921-01-01", end: str = "1954-12-31", kinds: tuple = TRANSFER_EVENTS) -> DataFrame:
    """Reference codes with a transfer of territory: those of the events themselves and, by event number, the other sides.

    ``events`` has entity, event_num, event_type and event_date; ``entities`` maps entity to code (its last row counts, by idx).
    """
    chosen = events.where(F.col("event_type").isin(*kinds) & F.col("event_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    names = entities.groupBy("entity").agg(F.max_by("code", "idx").alias("code"))
    own = chosen.join(names, "entity").select("code")
    numbers = chosen.select("event_num").distinct()
    for table, column in counterparts:
        own = own.union(table.join(numbers, "event_num", "left_semi").where(F.col(column).isNotNull()).select(F.col(column).alias("code")))
    return own.distinct().join(ref.select("code").distinct(), "code", "left_semi")

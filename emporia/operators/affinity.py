"""Items bought by the same entities: pair support, item support and the median pair support.

The plain self-join on the entity writes n²/2 pairs for an entity with n items. Three exact facts avoid most of
them:

* Pairs of support 1 are never needed, neither as results nor for the median: their number follows from sums, all
  pair occurrences (the sum of n(n-1)/2 over the entities) less the occurrences in pairs of support 2 or more. So
  items that only one entity has leave before the join.
* Two items with two entities in common share one that is not the largest basket of either. So an item leaves its
  largest basket before the join, where that is a large one, and the pairs that the others make look up whether the
  other item is in it.
* The few entities with the largest baskets never enter the join. Each item gets a bit mask of the ones it lies in;
  for a pair seen in other baskets the common bits are added, and pairs seen only in these baskets are counted from
  the mask classes (at most 2^12). They are listed only when they reach the wanted support, that is when they are
  part of the result. Items with a mask stay in all other baskets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.operators.joins import lookup, shuffle_tasks
from emporia.operators.ranking import weighted_lower_median
from emporia.sources.shared import written

LARGE_BASKET = 2000
LARGE_BASKETS = 12  # one bit each; items leave the largest of the further ones
#: A basket of more items than this is left by those items for which it is the largest.
TRIMMED_BASKET = 200


def _pairs(baskets: DataFrame, keys: list[str], item: str) -> DataFrame:
    left = baskets.withColumnRenamed(item, "_first")
    right = baskets.withColumnRenamed(item, "_second")
    return left.join(right, keys).where(F.col("_first") < F.col("_second"))


def affinity_pairs(
    purchases: DataFrame,
    entity: str,
    item: str,
    by: Sequence[str] = (),
    *,
    min_support: int = 3,
    large_basket: int = LARGE_BASKET,
    trimmed_basket: int = TRIMMED_BASKET,
) -> DataFrame:
    """Pairs of items held by at least ``min_support`` common entities, within each ``by`` group.

    Columns: ``by``, ``item_1`` < ``item_2``, ``support``, ``holders_1``, ``holders_2`` (entities per item) and
    ``median_support``, the lower median over all pairs of the group, whatever their support. An entity
    belongs to one group.
    """
    if min_support < 2:
        raise ValueError("min_support below 2 would list every pair of every basket")
    by = list(by)
    keys = [*by, entity]
    held = written(purchases.select(*keys, item).dropna().distinct(), "held")

    holders = held.groupBy(*by, item).agg(F.count(F.lit(1)).alias("_holders"))
    sizes = held.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    occurrences = sizes.groupBy(*by).agg(
        F.sum((F.col("_n") * (F.col("_n") - 1) / 2).cast("decimal(38,0)")).alias("_occurrences")
    )
    shared_items = written(holders.where(F.col("_holders") >= 2), "shared")
    baskets = written(lookup(held, shared_items.drop("_holders"), [*by, item], "inner"), "baskets")

    # At most LARGE_BASKETS rows come to the driver.
    large = (
        baskets.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > large_basket)
        .orderBy(F.desc("_n"), *keys)
        .limit(LARGE_BASKETS)
        .select(*keys)
        .collect()
    )
    if large:
        listed = [(*row, bit) for bit, row in enumerate(large)]
        schema = baskets.select(*keys).withColumn("_bit", F.lit(0)).schema
        large_frame = F.broadcast(baskets.sparkSession.createDataFrame(listed, schema))
        light = baskets.join(large_frame.drop("_bit"), keys, "left_anti")
        masks = written(
            baskets.join(large_frame, keys)
            .groupBy(*by, item)
            .agg(F.bit_or(F.expr("shiftleft(1, _bit)")).alias("_mask")),
            "masks",
        )
        # a pair of items with masks may have one entity in common here and others in the large baskets
        trimmed = _trimmed(light, keys, item, trimmed_basket, lookup(light, masks, [*by, item], "left_anti"))
        joint, histogram = _with_large(_supports(light, trimmed, by, entity, item), masks, by, item, min_support)
    else:
        trimmed = _trimmed(baskets, keys, item, trimmed_basket, baskets)
        joint = written(_supports(baskets, trimmed, by, entity, item), "pairs")
        histogram = joint.groupBy(*by, "support").agg(F.count(F.lit(1)).alias("_pairs"))

    median = written(_median(histogram, occurrences, by), "median")
    counted = joint.where(F.col("support") >= min_support)
    for side, name in (("_first", "holders_1"), ("_second", "holders_2")):
        counts = shared_items.withColumnRenamed(item, side).withColumnRenamed("_holders", name)
        counted = lookup(counted, counts, [*by, side], "inner", sample=joint)
    counted = lookup(counted, median, by, "inner", sample=joint) if by else counted.crossJoin(F.broadcast(median))
    result = counted.select(
        *by,
        F.col("_first").alias("item_1"),
        F.col("_second").alias("item_2"),
        "support",
        "holders_1",
        "holders_2",
        "median_support",
    )
    return written(result, "affinity")


def _trimmed(baskets: DataFrame, keys: list[str], item: str, limit: int, items: DataFrame) -> DataFrame | None:
    """The basket that each of ``items`` leaves, its largest one above ``limit``; none where no basket is that large."""
    sizes = baskets.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    sizes = written(sizes, "basket-sizes")
    if sizes.isEmpty():
        return None
    *by, entity = keys
    largest = F.max(F.struct("_n", F.col(entity).alias("_entity"))).alias("_largest")
    leaving = lookup(items.select(*keys, item), sizes, keys, "inner").groupBy(*by, item).agg(largest)
    return written(leaving.select(*by, item, F.col("_largest._entity").alias(entity)), "trimmed")


def _supports(baskets: DataFrame, trimmed: DataFrame | None, by: list[str], entity: str, item: str) -> DataFrame:
    """``by, _first, _second, support`` of all pairs with two entities in common, and of some with one."""
    keys = [*by, entity]
    counted = lambda held: _pairs(held, keys, item).groupBy(*by, "_first", "_second").agg(F.count(F.lit(1)).alias("support"))
    if trimmed is None:
        return counted(baskets)
    joint = written(counted(baskets.join(trimmed, [*keys, item], "left_anti")), "trimmed-pairs")
    for side in ("first", "second"):
        left = trimmed.withColumnRenamed(item, f"_{side}").withColumnRenamed(entity, f"_left_{side}")
        joint = lookup(joint, left, [*by, f"_{side}"], "left")
    # the basket that one item left counts when the other is in it; one that both left would count twice
    for side, other in (("first", "second"), ("second", "first")):
        there = baskets.select(*by, F.col(entity).alias(f"_left_{side}"), F.col(item).alias(f"_{other}"), F.lit(1).alias(f"_in_{side}"))
        joint = joint.join(there, [*by, f"_left_{side}", f"_{other}"], "left")
    both = F.coalesce(F.col("_left_first") == F.col("_left_second"), F.lit(False)).cast("int")
    more = F.coalesce("_in_first", F.lit(0)) + F.coalesce("_in_second", F.lit(0)) - both
    return joint.select(*by, "_first", "_second", (F.col("support") + more).cast("bigint").alias("support"))


def _with_large(
    light: DataFrame, masks: DataFrame, by: list[str], item: str, min_support: int
) -> tuple[DataFrame, DataFrame]:
    """Pair support and its histogram when some baskets are represented by masks; ``light`` has that of the others."""
    joint = light_pairs = written(light.withColumnRenamed("support", "_light"), "light")
    for side in ("_first", "_second"):
        named = masks.withColumnRenamed(item, side).withColumnRenamed("_mask", f"_mask{side}")
        joint = lookup(joint, named, [*by, side], "left", sample=light_pairs)
    common = F.coalesce(F.bit_count(F.col("_mask_first").bitwiseAND(F.col("_mask_second"))), F.lit(0))
    joint = joint.withColumn("_common", common).withColumn("support", F.col("_light") + F.col("_common"))
    joint = written(joint.select(*by, "_first", "_second", "_common", "support"), "pairs")

    # Pairs inside the large baskets by number of common baskets, from the sizes of the mask classes.
    classes = masks.groupBy(*by, "_mask").agg(F.count(F.lit(1)).alias("_items"))
    other = classes.select(*by, F.col("_mask").alias("_mask2"), F.col("_items").alias("_items2"))
    both = classes.join(other, by) if by else classes.crossJoin(F.broadcast(other))
    both = both.where(F.col("_mask") <= F.col("_mask2")).withColumn(
        "support", F.bit_count(F.col("_mask").bitwiseAND(F.col("_mask2"))).cast("bigint")
    )
    pairs_of = F.when(
        F.col("_mask") == F.col("_mask2"), (F.col("_items") * (F.col("_items") - 1) / 2).cast("decimal(38,0)")
    ).otherwise((F.col("_items") * F.col("_items2")).cast("decimal(38,0)"))
    inside = both.where(F.col("support") > 0).groupBy(*by, "support").agg(F.sum(pairs_of).alias("_pairs"))
    seen = (
        joint.where(F.col("_common") > 0)
        .groupBy(*by, F.col("_common").cast("bigint").alias("support"))
        .agg((-F.count(F.lit(1))).cast("decimal(38,0)").alias("_pairs"))
    )
    listed = joint.groupBy(*by, "support").agg(F.count(F.lit(1)).cast("decimal(38,0)").alias("_pairs"))
    histogram = (
        inside.unionByName(seen)
        .unionByName(listed)
        .groupBy(*by, "support")
        .agg(F.sum("_pairs").alias("_pairs"))
        .where(F.col("_pairs") > 0)
    )

    # Pairs that reach the support in large baskets alone are results; list the missing ones.
    links = both.where(F.col("support") >= min_support).select(*by, "_mask", "_mask2", "support")
    links = links.unionByName(
        links.where(F.col("_mask") != F.col("_mask2")).select(
            *by, F.col("_mask2").alias("_mask"), F.col("_mask").alias("_mask2"), "support"
        )
    )
    # A mask class is a hot key of at most 2^12 values, so its items are dealt out by their hash, and the other
    # side is repeated for every part: the rows that are made are results, and no task makes a whole class's.
    parts = shuffle_tasks(masks)
    first = masks.withColumnRenamed(item, "_first")
    second = masks.select(
        *by,
        F.col(item).alias("_second"),
        F.col("_mask").alias("_mask2"),
        F.pmod(F.xxhash64(item), F.lit(parts)).cast("int").alias("_part"),
    )
    only = (
        first.join(links, [*by, "_mask"])
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        .join(second, [*by, "_mask2", "_part"])
        .where(F.col("_first") < F.col("_second"))
        .select(*by, "_first", "_second", "support")
        .join(joint.select(*by, "_first", "_second"), [*by, "_first", "_second"], "left_anti")
    )
    return joint.select(*by, "_first", "_second", "support").unionByName(only), histogram


def _median(histogram: DataFrame, occurrences: DataFrame, by: list[str]) -> DataFrame:
    """Lower median support; the pairs of support 1 are what the other pairs leave of all occurrences.

    The histogram has one row per distinct support, at most the square root of twice the occurrences.
    """
    several = histogram.where(F.col("support") >= 2).select(
        *by, F.col("support").cast("bigint").alias("support"), F.col("_pairs").cast("decimal(38,0)").alias("_pairs")
    )
    used = several.groupBy(*by).agg(
        F.sum((F.col("support") * F.col("_pairs")).cast("decimal(38,0)")).alias("_used")
    )
    left = occurrences.join(used, by, "left") if by else occurrences.crossJoin(F.broadcast(used))
    single = left.select(
        *by,
        F.lit(1).cast("bigint").alias("support"),
        (F.col("_occurrences") - F.coalesce(F.col("_used"), F.lit(0))).cast("decimal(38,0)").alias("_pairs"),
    ).where(F.col("_pairs") > 0)
    return weighted_lower_median(several.unionByName(single), "support", "_pairs", "median_support", by)

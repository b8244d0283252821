"""Operators against brute force on small data with hot keys, ties and missing values."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from emporia.operators import affinity, ranking
from emporia.operators.affinity import affinity_pairs
from emporia.operators.cleaning import clean_table, dedup_keep_first, in_order
from emporia.operators.deviation import add_zscore, deviation_label
from emporia.operators.joins import following_days_count, heavy_keys, lookup, salted_lookup
from emporia.operators.ranking import global_rank, interpolated_median, lower_median
from emporia.operators.segmentation import median_segmentation
from emporia.sources.shared import written


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_keeps_first_and_is_idempotent(spark):
    df = spark.createDataFrame(
        [(1, 2, "b"), (1, 1, "z"), (1, 1, "a"), (2, None, "c"), (None, 0, "d")], "k int, o int, v string"
    )
    once = dedup_keep_first(df, ["k"], ["o"])
    assert rows_of(once) == Counter([(1, 1, "a"), (2, None, "c")])
    assert rows_of(dedup_keep_first(once, ["k"], ["o"])) == rows_of(once)


def test_invalid_first_line_drops_the_order(spark):
    lines = spark.createDataFrame(
        [(1, "p", -1, 1), (1, "p", 3, 2), (2, None, 1, 1), (3, "p", None, 1), (4, "q", 0, 1)],
        "id_commande int, id_produit string, quantite int, l_linenumber int",
    )
    with pytest.raises(ValueError, match="rang_source"):
        clean_table("details_commandes", lines)
    lines = in_order(lines, "l_linenumber")
    kept = clean_table("details_commandes", lines).select("id_commande", "id_produit", "quantite")
    assert rows_of(kept) == Counter([(4, "q", 0)])


def skewed(spark, n=3000):
    """A third of the rows have key 1, a tenth none, the rest are spread; key 7 has no match."""
    key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 500)
    return spark.range(n).select(key.cast("bigint").alias("k"), F.col("id").alias("v"))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_lookup_equals_plain_join(spark, how, null_safe):
    left = skewed(spark)
    right = spark.range(500).where("id <> 7").select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    right = right.unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k, CAST(-1 AS BIGINT) AS w"))
    on = left["k"].eqNullSafe(right["k"]) if null_safe else left["k"] == right["k"]
    plain = left.join(right, on, how).select(left["k"], "v", "w")
    salted = salted_lookup(left, right, ["k"], how, null_safe=null_safe).select("k", "v", "w")
    assert rows_of(salted) == rows_of(plain)
    routed = lookup(left, right, "k", how, null_safe=null_safe, limit=0).select("k", "v", "w")
    assert rows_of(routed) == rows_of(plain)


def test_salting_spreads_the_hot_key(spark):
    left = skewed(spark, 30_000)
    heavy = {r["k"] for r in heavy_keys(left.select("k"), ["k"], share=20).collect()}
    assert heavy == {1, None}


def test_lookup_broadcasts_a_small_side_only(spark):
    left, right = skewed(spark), spark.range(10).select(F.col("id").alias("k"), F.col("id").alias("w"))
    assert "_salt" not in plan_of(lookup(left, right, "k"))
    assert "_salt" in plan_of(lookup(left, right, "k", limit=0))


def test_following_days(spark):
    days = spark.sql("SELECT explode(array(DATE '2024-01-01', DATE '2024-01-05', DATE '2024-02-01', NULL)) AS d")
    events = spark.sql("SELECT explode(array(DATE '2024-01-01', DATE '2024-01-08', DATE '2024-01-08', DATE '2024-01-13')) AS e")
    counted = following_days_count(days, "d", events, "e", 7, "n")
    assert {str(r["d"]): r["n"] for r in counted.collect()} == {
        "2024-01-01": 3,
        "2024-01-05": 2,
        "2024-02-01": 0,
        "None": 0,
    }
    assert "NestedLoop" not in plan_of(counted) and "Cartesian" not in plan_of(counted)


def values(spark, seed, rows=2000):
    """Groups of very different size, many ties, a value that fills a third of the rows, some NULLs."""
    rng = random.Random(seed)
    data = []
    for i in range(rows):
        group = rng.choice(["a", "a", "a", "b", None])
        value = None if i % 50 == 0 else 5.0 if i % 3 == 0 else round(rng.gauss(0, 20), rng.choice([0, 1]))
        data.append((i, group, value))
    return spark.createDataFrame(data, "id int, g string, v double")


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("seed", [1, 2])
def test_distributed_rank_equals_window(spark, by, seed):
    df = values(spark, seed)
    window = Window.partitionBy(*by).orderBy(F.col("v").desc_nulls_last())
    expected = df.withColumn("r", F.rank().over(window).cast("bigint"))
    assert rows_of(global_rank(df, "v", "r", by)) == rows_of(expected)
    assert rows_of(global_rank(df, "v", "r", by, rows=2000)) == rows_of(expected)


@pytest.mark.parametrize("by", [[], ["g"]])
def test_distributed_median_equals_aggregate(spark, by):
    df = values(spark, 3)
    plain = lower_median(df, {"v": "m", "id": "i"}, by, rows=2000)
    assert rows_of(lower_median(df, {"v": "m", "id": "i"}, by)) == rows_of(plain)
    assert plain.schema["i"].dataType.simpleString() == "int"


def test_lower_and_interpolated_median(spark):
    df = spark.createDataFrame([(v,) for v in (1, 1, 1, 4, 5, 6, 7, 8, 9, 10)], "v int")
    for rows in (None, 10):
        assert lower_median(df, {"v": "m"}, rows=rows).first()["m"] == 5
        assert interpolated_median(df, "v", "m", rows=rows).first()["m"] == 5.5


def test_segmentation_counts(spark):
    df = values(spark, 4).dropna(subset=["v"]).withColumn("w", F.col("v") * F.col("id"))
    segments = ("A", "B", "C", "D")
    plain = median_segmentation(df, "v", "w", ["g"], segments=segments)
    split = median_segmentation(df, "v", "w", ["g"], segments=segments, plain_rows=0)
    assert rows_of(plain.select(sorted(plain.columns))) == rows_of(split.select(sorted(plain.columns)))
    assert plain.count() == df.where("g IS NOT NULL").count()


def test_one_table_of_positions_for_all_ranks_and_medians(spark, monkeypatch):
    rng, labels = random.Random(6), []
    rows = [
        (i, rng.choice(["a", "b", None]), rng.choice([None, 2**60 + 1, 2**60, -3, i % 7]), rng.choice([None, -0.5, 1e300, i / 3]))
        for i in range(600)
    ] + [(900 + i, "c", None, None) for i in range(3)]
    df = spark.createDataFrame(rows, "id int, g string, v long, w double")
    plain = median_segmentation(df, "v", "w", ["g"], segments=("A", "B", "C", "D"), total_rank="t")
    note = lambda frame, label: labels.append(label) or written(frame, label)
    monkeypatch.setattr(ranking, "written", note)
    split = median_segmentation(df, "v", "w", ["g"], segments=("A", "B", "C", "D"), total_rank="t", plain_rows=0)
    assert labels.count("positions") == 1 and labels.count("shared") == 1
    columns = sorted(set(plain.columns) - {"segment"})  # a group without values has no median to compare with
    assert rows_of(plain.select(columns)) == rows_of(split.select(columns))
    with pytest.raises(ValueError, match="neither"):
        ranking.shared_positions(df, ["g"])


def test_zscore_of_a_single_value(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b", 1.0)], "g string, v double")
    scored = add_zscore(df, "v", "g", "z").select("z", deviation_label(F.col("z"), "hi", "lo", "no").alias("s"))
    assert rows_of(scored) == Counter([(None, "no")] * 3)


def brute_pairs(purchases, min_support):
    items = defaultdict(set)
    for group, entity, item in purchases:
        items[(group, entity)].add(item)
    support, holders = Counter(), Counter()
    for (group, _), owned in items.items():
        holders.update((group, i) for i in owned)
        support.update((group, *pair) for pair in combinations(sorted(owned), 2))
    medians = {}
    for group in {g for g, *_ in support}:
        ordered = sorted(n for (g, *_), n in support.items() if g == group)
        medians[group] = ordered[(len(ordered) + 1) // 2 - 1]
    return Counter(
        (g, a, b, n, holders[(g, a)], holders[(g, b)], medians[g])
        for (g, a, b), n in support.items()
        if n >= min_support
    )


def purchases(seed, groups, large):
    """Small random baskets and a few that hold most items."""
    rng = random.Random(seed)
    rows = []
    for entity in range(60):
        group = groups[entity % len(groups)]
        size = rng.randint(0, 5) if entity >= large else rng.randint(25, 40)
        rows += [(group, entity, f"i{rng.randint(0, 44):02d}") for _ in range(size)]
    return rows + rows[:20]  # repeated purchases count once


@pytest.mark.parametrize("groups", [["x"], ["x", "y", "z"]])
@pytest.mark.parametrize(
    ("large", "limit", "trimmed"),
    [(0, 1000, 1000), (1, 12, 1000), (3, 12, 2), (5, 12, 1000), (16, 12, 0), (16, 1000, 0), (12, 1000, 10), (16, 1000, 1000)],
)
def test_affinity_equals_brute_force(spark, groups, large, limit, trimmed):
    data = purchases(large + len(groups), groups, large)
    df = spark.createDataFrame(data, "g string, e int, i string")
    limits = {"large_basket": limit, "trimmed_basket": trimmed}
    found = affinity_pairs(df, "e", "i", ["g"], min_support=3, **limits)
    assert rows_of(found) == brute_pairs(data, 3)
    if len(groups) == 1:
        plain = affinity_pairs(df, "e", "i", min_support=2, **limits)
        assert rows_of(plain) == Counter({k[1:]: n for k, n in brute_pairs(data, 2).items()})


def test_items_leave_their_largest_basket(spark, monkeypatch):
    """The join makes far fewer rows than the baskets have pairs, and the result is the same."""
    rng, made = random.Random(3), []
    rows = [("x", e, f"i{i}") for e in range(12) for i in rng.sample(range(4000), 300)]  # large baskets that meet seldom
    rows += [("x", 100 + e, f"i{rng.randrange(4000)}") for e in range(1500) for _ in range(4)]
    pairs = affinity._pairs
    monkeypatch.setattr(affinity, "_pairs", lambda *a: made.append(pairs(*a)) or made[-1])
    df = spark.createDataFrame(rows, "g string, e int, i string")
    found = affinity_pairs(df, "e", "i", ["g"], min_support=2, trimmed_basket=100)
    assert rows_of(found) == brute_pairs(rows, 2)
    every = sum(n * (n - 1) // 2 for n in Counter(e for _, e, _ in set(rows)).values())
    assert made[0].count() < 0.4 * every


def test_more_large_baskets_than_eight(spark):
    rng, n = np.random.default_rng(1), 3000
    held = np.zeros((9, n), np.int64)
    for row in held:
        row[rng.choice(n, 1200, replace=False)] = 1
    df = spark.createDataFrame([(e, int(i)) for e in range(9) for i in np.nonzero(held[e])[0]], "e int, i int")
    found = affinity_pairs(df, "e", "i", min_support=7, large_basket=1000)
    together = np.triu(held.T @ held, 1)
    supports = np.sort(together[together > 0])
    assert found.count() == (together >= 7).sum() > 0
    row = found.orderBy("item_1", "item_2").first()
    first, second = np.argwhere(together >= 7)[0]
    assert (row.item_1, row.item_2, row.support) == (first, second, together[first, second])
    assert row.median_support == supports[(len(supports) + 1) // 2 - 1]


def test_affinity_without_pairs(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (3, None)], "e int, i string")
    assert affinity_pairs(df, "e", "i").count() == 0
    with pytest.raises(ValueError, match="min_support"):
        affinity_pairs(df, "e", "i", min_support=1)


def test_affinity_joins_on_keys_only(spark):
    """The plan of the pair join itself; what the operator returns is a written table."""
    data = purchases(1, ["x"], 2)
    baskets = spark.createDataFrame(data, "g string, e int, i string")
    plan = plan_of(affinity._pairs(baskets, ["g", "e"], "i"))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "Join [g" in plan and "e#" in plan

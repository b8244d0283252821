"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, up to ``repeats`` times over. A copy's virtual finish
time is its source's words up to its end divided by the source's target, which is the source's weight in the queue.
The copies of all sources are sorted by finish time in ranges and served until the budget, the words of all documents,
is used up; the copy in service then is cut there. Nothing else bounds a source: that each ends near its target, no
further off than the longest document, follows from the order alone.

Queues are long (one source may have a third of all rows), so no task holds one: the shuffle order is a hash of id,
text and a number that tells equal rows apart, rows are dealt out by ranges of it, and running sums are those within
a range plus the total of the ranges before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporia.llm.common import WORD, parts_for, pick
from emporia.sources.shared import written

ROWS_PER_RANGE = 100_000
_DIGITS, _SPACE = 13, 16**13


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(
    sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), repeats: int = 3, per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``, one row per source.

    Sources by code point, null last, get the weights in turn. They share the total by weight; a target stops at
    ``repeats`` times its source's size and the excess is shared again by weight until none is above. More sources
    than ``per_range`` are put in order in ranges.
    """
    sizes = written(sizes.withColumn("one", F.lit(1)), "source-sizes")
    count, words = sizes.agg(F.count(F.lit(1)), F.sum("source_size")).first()
    by_name = [F.col("source").asc_nulls_last()]
    turn = F.col("turn") % len(weights) + 1
    weighed = _sums_before(sizes, by_name, {"one": "turn"}, count, per_range)
    weighed = weighed.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), turn.cast("int")))
    # in the order in which sources reach their limit, all before the first that does not are at their limit
    weighed = weighed.withColumn("limit", F.col("source_size") * repeats)
    ranked = [F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last()]
    tried = _sums_before(weighed, ranked, {"limit": "limits", "weight": "weights"}, count, per_range)
    whole = count // len(weights) * sum(weights) + sum(weights[: count % len(weights)])
    level = (F.lit(words) - F.col("limits")) / (F.lit(whole) - F.col("weights"))
    tried = written(tried.withColumn("level", level), "levels")
    fits = F.col("level") * F.col("weight") <= F.col("limit")
    share = F.lit(tried.agg(F.max(F.when(fits, F.col("level")))).first()[0]).cast("double")
    target = F.least(F.col("limit").cast("double"), share * F.col("weight"))
    return tried.select("source", "source_size", target.alias("target"))


def _sums_before(rows: DataFrame, order: list, values: dict[str, str], count: int, per_range: int) -> DataFrame:
    """``rows``, counted, with the sums of ``values`` over the rows before; no task orders more than a range."""
    if count <= per_range:
        before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumns({into: F.coalesce(F.sum(v).over(before), F.lit(0)) for v, into in values.items()})
    dealt = rows.repartitionByRange(-(-count // per_range), *order).withColumn("part", F.spark_partition_id())
    dealt = written(dealt, "source-ranges")
    for value, into in values.items():
        dealt = _running(dealt, [], order, value, into)
    return dealt.drop("part")


def _running(rows: DataFrame, keys: list[str], order: list, value: str, into: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over the rows before, per ``keys``, in order of ``part`` and ``order``."""
    totals = written(rows.groupBy(*keys, "part").agg(F.sum(value).alias("_sum")), "range-totals")
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(*keys, "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn(into, F.coalesce(F.sum(value).over(within), F.lit(0)))
    same = [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in [*keys, "part"]]
    offsets = offsets.toDF(*[f"_o_{k}" for k in [*keys, "part"]], "_before")
    return summed.join(offsets, same).withColumn(into, F.col(into) + F.col("_before")).drop(*offsets.columns)


def queues(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """Every row with its words and its place in its source's shuffled queue: ``size, start, place``, written once.

    Rows that repeat are counted before they are shuffled and numbered from their count, so they spread like others.
    """
    text = F.col("text")
    slim = pick(docs, "doc_id", "text", "source").select(
        "doc_id", "source", words_of(text).alias("size"), F.xxhash64("text").alias("version"), F.md5(text).alias("digest")
    )
    alike = slim.groupBy("doc_id", "source", "size", "version", "digest").agg(F.count(F.lit(1)).alias("rows"))
    told = [F.lit(seed), *(F.coalesce(c, F.lit("")) for c in (F.col("doc_id").cast("string"), F.col("digest")))]
    each = alike.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    key = F.md5(F.concat_ws(":", *told, F.col("nth").cast("string")))
    each = written(each.select("doc_id", "source", "size", "version", key.alias("key")), "sizes")
    parts = parts_for(docs, each.count(), ROWS_PER_RANGE)
    at = F.conv(F.substring("key", 1, _DIGITS), 16, 10).cast("long") / _SPACE
    dealt = each.withColumn("part", F.floor(at * parts).cast("int")).withColumn("one", F.lit(1))
    summed = _running(dealt, ["source"], ["key"], "size", "start")
    return written(_running(summed, ["source"], ["key"], "one", "place"), "queues")


def copies(queue: DataFrame, aims: DataFrame, repeats: int = 3) -> DataFrame:
    """``source, place, copy, size, finish`` of the copies of all documents that have words."""
    aims = aims.toDF("_source", "source_size", "target")
    queued = queue.filter(F.col("size") > 0).join(aims, F.col("source").eqNullSafe(F.col("_source")))
    made = queued.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    ends = F.col("copy") * F.col("source_size") + F.col("start") + F.col("size")
    return made.select("source", "place", "copy", "size", (ends / F.col("target")).alias("finish"))


def schedule(made: DataFrame, budget: int) -> DataFrame:
    """The served copies: ``source, place, copy, finish, words, mix_start``, in the order of their finish times.

    ``mix_start`` is the number of words before a copy in the mix, ``words`` its size or, where the budget ends in it,
    what is left of the budget. Ties in time go by source (null last), copy and place.
    """
    order = [F.col("finish"), F.col("source").asc_nulls_last(), F.col("copy"), F.col("place")]
    made = written(made, "copies")
    dealt = made.repartitionByRange(parts_for(made, made.count(), ROWS_PER_RANGE), *order)
    dealt = written(dealt.withColumn("part", F.spark_partition_id()), "finish-ranges")
    left = F.lit(budget) - F.col("mix_start")
    served = _running(dealt, [], order, "size", "mix_start").filter(left > 0)
    return served.withColumn("words", F.least(F.col("size"), left)).drop("part", "size")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), repeats: int = 3) -> DataFrame:
    """``doc_id, source, version, size, source_size, target, taken`` for every row; ``version`` hashes the text.

    ``size`` counts the words (null text: none); ``target`` is the number of words asked of the row's source, and
    ``taken`` the words that the mix takes of the row, repeats counted, at most ``repeats`` times its size. All taken
    words together are the words of the table, and each source's differ from its target by the longest document at
    most. Rows that repeat are separate documents; a null source is a source. With nothing but empty texts all targets
    are zero, and an empty table gives no rows. A very long text is one document, which is served whole or cut where the
    budget ends. The same rows give the same mix in every run.
    """
    queue = queues(docs)
    sizes = queue.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = written(targets(sizes, weights, repeats), "targets")
    budget = aims.agg(F.sum("source_size")).first()[0] or 0
    plan = schedule(copies(queue, aims, repeats), budget).groupBy("source", "place").agg(F.sum("words").alias("taken"))
    plan = plan.toDF("_p_source", "_p_place", "taken")
    named = aims.toDF("_source", "source_size", "target")
    same = F.col("source").eqNullSafe(F.col("_p_source")) & (F.col("place") == F.col("_p_place"))
    return (
        queue.join(plan, same, "left")
        .join(named, F.col("source").eqNullSafe(F.col("_source")))
        .select(
            "doc_id", "source", "version", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
        )
    )

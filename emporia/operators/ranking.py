"""Exact ranks and lower medians over groups that do not fit in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.operators.joins import lookup, null_safe_join
from emporia.sources.shared import written

PLAIN_ROWS = 200_000  # a frame counted to be no larger than this may be ordered by one task


def value_positions(df: DataFrame, value: str, by: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Distinct values per group: count ``_n``, rows with a smaller value ``_below``, group size ``_all``.

    Equal values are counted first, so a value that fills a third of the table is one row from then on. The
    counted values are dealt out in ranges of group and value (``buckets`` of them, or as many as the session
    shuffles into) and written with the number of their range, so that every reader and every retried task sees
    the same ranges. A task orders one range, and the totals of the ranges give its offset.
    """
    by = list(by)
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    order = [*by, value]
    dealt = counted.repartitionByRange(buckets, *order) if buckets else counted.repartitionByRange(*order)
    placed = written(dealt.withColumn("_bucket", F.spark_partition_id()), "positions")
    sizes = placed.groupBy(*by, "_bucket").agg(F.sum("_n").alias("_rows"))
    group = Window.partitionBy(*by)
    before = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *by,
        "_bucket",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
        F.sum("_rows").over(group).alias("_all"),
    )
    inside = Window.partitionBy(*by, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    running = placed.withColumn("_running", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    return null_safe_join(running, offsets, [*by, "_bucket"]).select(
        *by, value, "_n", (F.col("_offset") + F.col("_running")).alias("_below"), "_all"
    )


def shared_positions(df: DataFrame, values: Sequence[str], by: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """The positions of several columns in one written table, told apart by ``_measure``, the name of the column.

    Ranks and medians of all these columns read it, so a frame is counted, dealt out and ordered once.
    """
    by = list(by)
    measures = [F.struct(F.lit(c).alias("_measure"), _orderable(df, c).alias("_value")) for c in values]
    rows = df.select(*by, F.explode(F.array(*measures)).alias("_m")).select(*by, "_m.*")
    return written(value_positions(rows, "_value", [*by, "_measure"], buckets), "shared")


def _orderable(df: DataFrame, column: str) -> Column:
    """A column as a struct that holds whole numbers and fractions without loss and orders them; NULL for NULL."""
    kind = df.schema[column].dataType
    whole = isinstance(kind, T.IntegralType)
    if not whole and not isinstance(kind, (T.DoubleType, T.FloatType)):
        raise ValueError(f"{column} is neither a whole number nor a fraction: {kind.simpleString()}")
    value, none = F.col(column), F.lit(None)
    held = F.struct(
        (value if whole else none).cast("bigint").alias("whole"), (none if whole else value).cast("double").alias("real")
    )
    return F.when(value.isNotNull(), held)


def _positions_of(df: DataFrame, positions: DataFrame | None, value: str, by: list[str]) -> DataFrame:
    """The positions of one column: read off the shared table, or made for it."""
    if positions is None:
        return value_positions(df, value, by)
    kind = df.schema[value].dataType
    held = F.col("_value.whole") if isinstance(kind, T.IntegralType) else F.col("_value.real")
    return positions.where(F.col("_measure") == value).select(*by, held.cast(kind).alias(value), "_n", "_below", "_all")


def global_rank(
    df: DataFrame,
    value: str,
    name: str,
    by: Sequence[str] = (),
    *,
    rows: int | None = None,
    plain_rows: int = PLAIN_ROWS,
    source: DataFrame | None = None,
    positions: DataFrame | None = None,
) -> DataFrame:
    """Add the descending rank (ties share it, gaps follow) of ``value`` within each group, NULLs last.

    With a counted small number of ``rows`` this is the plain window; otherwise ranks are read off the value
    positions, and no task sees a whole group. ``source`` may name a frame with the same groups and values
    that is cheaper to read again than ``df``, such as the written table that ``df`` was made from, and
    ``positions`` the shared positions of its columns.
    """
    by = list(by)
    if rows is not None and rows <= plain_rows:
        ordered = Window.partitionBy(*by).orderBy(F.col(value).desc_nulls_last())
        return df.withColumn(name, F.rank().over(ordered).cast("bigint"))
    known = df if source is None else source
    ranks = _positions_of(known, positions, value, by).select(
        *by, value, (F.col("_all") - F.col("_below") - F.col("_n") + 1).cast("bigint").alias(name)
    )
    missing = known.groupBy(*by).agg(
        F.lit(None).cast(known.schema[value].dataType).alias(value), (F.count(value) + 1).alias(name)
    )
    # Written: the exact size decides between a broadcast and a salted join, and ``df`` is planned only once.
    ranks = written(ranks.unionByName(missing), "ranks")
    return lookup(df, ranks, [*by, value], "inner", null_safe=True, sample=known).select(*df.columns, name)


def lower_median(
    df: DataFrame,
    values: dict[str, str],
    by: Sequence[str] = (),
    *,
    rows: int | None = None,
    plain_rows: int = PLAIN_ROWS,
    positions: DataFrame | None = None,
) -> DataFrame:
    """Lower median of each value column per group, one row per group: ``{column: result name}``.

    ``positions`` may be the shared positions of the columns.
    """
    by = list(by)
    if rows is not None and rows <= plain_rows:
        return df.groupBy(*by).agg(
            *[
                F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{v}`)").cast(df.schema[v].dataType).alias(n)
                for v, n in values.items()
            ]
        )
    merged = df.select(*by).distinct() if by else None
    for value, name in values.items():
        middle = F.ceil(F.col("_all") / 2)
        one = (
            _positions_of(df, positions, value, by)
            .where((F.col("_below") < middle) & (middle <= F.col("_below") + F.col("_n")))
            .select(*by, F.col(value).alias(name))
        )
        if by:
            merged = null_safe_join(merged, one, by, "left")
        else:
            merged = one if merged is None else merged.crossJoin(F.broadcast(one))
    return merged


def interpolated_median(
    df: DataFrame, value: str, name: str, *, rows: int | None = None, plain_rows: int = PLAIN_ROWS
) -> DataFrame:
    """Median of all non-NULL values, the mean of the two middle ones for an even count; one row."""
    if rows is not None and rows <= plain_rows:
        return df.agg(F.expr(f"percentile(`{value}`, 0.5)").alias(name))
    low, high = F.ceil(F.col("_all") / 2), F.floor(F.col("_all") / 2) + 1
    last = F.col("_below") + F.col("_n")
    middle = value_positions(df, value).select(
        F.when((F.col("_below") < low) & (low <= last), F.col(value)).alias("_low"),
        F.when((F.col("_below") < high) & (high <= last), F.col(value)).alias("_high"),
    )
    return middle.agg(((F.max("_low") + F.max("_high")) / 2).alias(name))


def weighted_lower_median(
    histogram: DataFrame, value: str, weight: str, name: str, by: Sequence[str] = ()
) -> DataFrame:
    """Lower median of a value given how often each distinct value occurs (one row per value and group)."""
    by = list(by)
    group = Window.partitionBy(*by)
    ordered = group.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    placed = histogram.select(
        *by,
        value,
        weight,
        F.coalesce(F.sum(weight).over(ordered), F.lit(0)).alias("_below"),
        F.ceil(F.sum(weight).over(group) / 2).alias("_middle"),
    )
    hit = (F.col("_below") < F.col("_middle")) & (F.col("_middle") <= F.col("_below") + F.col(weight))
    return placed.where(hit).select(*by, F.col(value).alias(name))

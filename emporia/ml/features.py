"""Feature tables: encoding, scaling, splits, time lags, and simple profiles."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emporia.operators.joins import lookup
from emporia.operators.ranking import value_positions
from emporia.sources.shared import written

def dictionary(df: DataFrame, column: str) -> DataFrame:
    """``value, place`` of the distinct present values, numbered from 0 in sorted order; a written table of any size."""
    values = df.select(F.col(column).alias("value")).dropna().distinct()
    return written(value_positions(values, "value").select("value", F.col("_below").cast("long").alias("place")), "dictionary")


def one_hot(df: DataFrame, column: str, values: Sequence[str], *, drop_first: bool = False) -> tuple[DataFrame, list[str]]:
    """0/1 columns ``column_value`` for the given values; a missing value, and any other, is zero in all of them.

    For a few values that the caller knows. :func:`one_hot_vectors` takes as many as the data have.
    """
    kept = list(values)[1:] if drop_first else list(values)
    names = [f"{column}_{value}" for value in kept]
    coded = {
        name: F.coalesce((F.col(column) == value).cast("int"), F.lit(0)) for name, value in zip(names, kept)
    }
    return df.withColumns(coded).drop(column) if coded else df.drop(column), names


def one_hot_vectors(
    df: DataFrame, column: str, output: str, held: DataFrame | None = None, *, drop_first: bool = False
) -> DataFrame:
    """A sparse 0/1 vector ``output`` in the order of the dictionary ``held``, which is made where none is given.

    A missing value, and one that the dictionary does not have, is all zeros; with ``drop_first`` so is the first one.
    """
    held = dictionary(df, column) if held is None else held
    size = (held.agg(F.max("place")).first()[0] or 0) + (0 if drop_first else 1) if not held.isEmpty() else 0
    if drop_first:
        held = held.where(F.col("place") > 0).withColumn("place", F.col("place") - 1)
    coded = lookup(df, held.toDF(column, "_place"), column, "left")
    # the category after the last one is dropped by the encoder, so it stands for no value
    coded = coded.withColumn("_place", F.coalesce("_place", F.lit(size)).cast("double"))
    known = df.sparkSession.createDataFrame([(float(size),)], "_place double")
    encoder = OneHotEncoder(inputCols=["_place"], outputCols=[output], dropLast=True).fit(known)
    return encoder.transform(coded).select(*df.columns, output)


def scaling(train: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the mean and the population standard deviation of each column."""
    return train.agg(
        *[F.avg(c).alias(f"_mean_{c}") for c in columns], *[F.stddev_pop(c).alias(f"_std_{c}") for c in columns]
    )


def standardise(df: DataFrame, columns: list[str], stats: DataFrame | None = None) -> DataFrame:
    """Centre and scale the columns; a constant column becomes zero."""
    stats = scaling(df, columns) if stats is None else stats
    scaled = {
        c: F.when(F.col(f"_std_{c}") == 0, F.lit(0.0) * F.col(c)).otherwise(
            F.try_divide(F.col(c) - F.col(f"_mean_{c}"), F.col(f"_std_{c}"))
        )
        for c in columns
    }
    return df.crossJoin(F.broadcast(stats)).withColumns(scaled).drop(*stats.columns)


def split_random(df: DataFrame, key: str, test_share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by the MD5 of the key: the same on every run, partitioning, retry and engine."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    test = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 10_000 < int(test_share * 10_000)
    return df.where(~test), df.where(test)


def split_ordered(df: DataFrame, group: str, day: str, test_share: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """First and last rows in the order group, day: the last groups are held out, not the last days.

    Rows are counted per day and group, and the position of each such pair among all is read off ranges of
    them, so no task orders more than a range. Rows of one group and day go to the same part.
    """
    place = F.struct(F.col(group).alias("g"), F.col(day).alias("d"))
    placed = value_positions(df.withColumn("_at", place), "_at")
    train_rows = F.col("_all") - F.ceil(F.col("_all") * test_share)
    marks = placed.select(
        F.col("_at.g").alias("_g"), F.col("_at.d").alias("_d"), (F.col("_below") < train_rows).alias("_train")
    )
    same = F.col(group).eqNullSafe(F.col("_g")) & F.col(day).eqNullSafe(F.col("_d"))
    parts = df.join(marks, same)
    return parts.where("_train").select(*df.columns), parts.where("NOT _train").select(*df.columns)


def split_by_time(df: DataFrame, day: str, cutoff: str) -> tuple[DataFrame, DataFrame]:
    """Rows before the cutoff day and rows from it on."""
    late = F.col(day) >= F.to_date(F.lit(cutoff))
    return df.where(~late), df.where(late)


def lag_features(monthly: DataFrame, group: str, day: str, value: str, *, leak_free: bool = True) -> DataFrame:
    """Previous two values, mean of three and relative change per group, in time order.

    ``leak_free`` builds mean and change from earlier months only; otherwise they include the current month,
    which the target is part of. A group has one row per month, so its window is bounded by the calendar.
    """
    ordered = Window.partitionBy(group).orderBy(day)
    last, previous = F.lag(value, 1).over(ordered), F.lag(value, 2).over(ordered)
    three = ordered.rowsBetween(-3, -1) if leak_free else ordered.rowsBetween(-2, 0)
    mean = F.when(F.count(value).over(three) == 3, F.avg(value).over(three))
    newer, older = (last, previous) if leak_free else (F.col(value), last)
    return monthly.withColumns(
        {
            f"{value}_prec": last,
            f"{value}_prec_2": previous,
            "moyenne_mobile_3m": mean,
            "variation_pourcent": F.try_divide(newer - older, older),
        }
    )


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns as rows, each pair over the rows where both are present."""
    pairs = list(combinations_with_replacement(columns, 2))
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    one = doubles.agg(*[F.corr(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for first, second in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(first).alias("a"), F.lit(second).alias("b"), F.col(f"_{i}").alias("r")))
    return one.select(F.explode(F.array(*cells)).alias("_c")).select("_c.a", "_c.b", "_c.r")


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Row count of equal-width bins from the minimum to the maximum; the last bin includes its upper edge."""
    values = df.select(F.col(column).cast("double").alias("_v")).dropna()
    span = F.broadcast(values.agg(F.min("_v").alias("_low"), F.max("_v").alias("_high")))
    position = F.floor(F.try_divide(F.col("_v") - F.col("_low"), F.col("_high") - F.col("_low")) * bins)
    placed = values.crossJoin(span).select(
        F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).cast("int").alias("bin")
    )
    counts = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("_n"))
    width = (F.col("_high") - F.col("_low")) / bins
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).crossJoin(span)
    return every.join(counts, "bin", "left").select(
        "bin",
        (F.col("_low") + width * F.col("bin")).alias("low"),
        (F.col("_low") + width * (F.col("bin") + 1)).alias("high"),
        F.coalesce("_n", F.lit(0)).cast("bigint").alias("rows"),
    )


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, missing values, mean, sample deviation, minimum and maximum per column, in one pass."""
    figures = {
        "present": lambda c: F.count(c).cast("double"),
        "missing": lambda c: F.count_if(F.col(c).isNull()).cast("double"),
        "mean": lambda c: F.avg(c),
        "std": lambda c: F.stddev_samp(c),
        "min": lambda c: F.min(c).cast("double"),
        "max": lambda c: F.max(c).cast("double"),
    }
    one = df.agg(*[make(c).alias(f"{c}|{name}") for c in columns for name, make in figures.items()])
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}|{name}`").alias(name) for name in figures])
            for c in columns
        ]
    )
    return one.select(F.explode(rows).alias("_r")).select("_r.*")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))

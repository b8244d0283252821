"""Deviation of daily figures from the mean of their calendar group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HIGH, LOW = 1.5, -1.5


def add_zscore(daily: DataFrame, value: str, group: str, name: str, *, mean: str = "", deviation: str = "") -> DataFrame:
    """Add the z-score of ``value`` within its calendar group; NULL for a group of one or without spread.

    The statistics are one row per group; Catalyst broadcasts them when they are as small as those of a calendar.
    """
    mean_name, deviation_name = mean or f"_mean_{group}", deviation or f"_std_{group}"
    stats = daily.groupBy(group).agg(
        F.avg(value).alias(mean_name), F.stddev_samp(value).alias(deviation_name)
    )
    scored = daily.join(stats, group).withColumn(
        name, F.try_divide(F.col(value) - F.col(mean_name), F.col(deviation_name))
    )
    return scored.drop(*[c for c, kept in ((mean_name, mean), (deviation_name, deviation)) if not kept])


def deviation_label(score: Column, high: str, low: str | None, normal: str) -> Column:
    label = F.when(score >= HIGH, high)
    if low is not None:
        label = label.when(score <= LOW, low)
    return label.otherwise(normal)

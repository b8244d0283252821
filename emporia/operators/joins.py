"""Joins that stay balanced when one key holds a large share of the rows, and the following-days count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.sources.shared import broadcast_limit, planned_bytes


def shuffle_tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equally named columns where a missing value matches a missing value; keeps the left columns once."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = None
    for key in keys:
        same = F.col(key).eqNullSafe(F.col(f"_r_{key}"))
        on = same if on is None else on & same
    joined = left.join(renamed, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_r_{c}" for c in keys])


def heavy_keys(df: DataFrame, keys: list[str], share: int | None = None) -> DataFrame:
    """Key combinations with at least ``1/share`` of all rows, and the tasks (``_salts``) that these would fill.

    ``share`` defaults to the number of shuffle tasks: a key is heavy when it holds more than an even task does,
    so there are never more heavy keys than tasks, and their salts are at most twice as many.
    """
    share = share or shuffle_tasks(df)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_key_rows"))
    total = counts.agg(F.sum("_key_rows").alias("_all_rows"))
    salts = F.ceil(F.col("_key_rows") * share / F.col("_all_rows")).cast("int")
    return (
        counts.crossJoin(F.broadcast(total))
        .where(F.col("_key_rows") * share >= F.col("_all_rows"))
        .select(*keys, salts.alias("_salts"))
    )


def salted_lookup(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "left",
    *,
    null_safe: bool = False,
    share: int | None = None,
    sample: DataFrame | None = None,
) -> DataFrame:
    """Join to a table that is unique on ``keys``; rows of heavy or missing keys spread over several tasks.

    A heavy key gets as many salts as its rows would fill tasks, and only the right-hand rows of heavy keys are
    repeated. ``sample`` may name a cheaper frame with the same key distribution; it steers the balance only,
    never the result.
    """
    heavy = F.broadcast(heavy_keys((sample if sample is not None else left).select(*keys), keys, share))
    spread = F.pmod(F.xxhash64(*left.columns), F.col("_salts")).cast("int")
    tagged = (
        null_safe_join(left, heavy, keys, "left")
        .withColumn("_salt", F.when(F.col("_salts").isNotNull(), spread).otherwise(F.lit(0)))
        .drop("_salts")
    )
    copies = F.when(F.col("_salts").isNotNull(), F.sequence(F.lit(0), F.col("_salts") - 1)).otherwise(F.array(F.lit(0)))
    repeated = null_safe_join(right, heavy, keys, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    if null_safe:
        return null_safe_join(tagged, repeated, [*keys, "_salt"], how).drop("_salt")
    return tagged.join(repeated, [*keys, "_salt"], how).drop("_salt")


def lookup(
    left: DataFrame,
    right: DataFrame,
    keys: str | list[str],
    how: str = "left",
    *,
    null_safe: bool = False,
    sample: DataFrame | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Join to a table that is unique on ``keys``.

    A right side whose planned size is within the broadcast limit is left to Catalyst, which broadcasts it;
    a larger one takes the salted shuffle join.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    limit = broadcast_limit(left.sparkSession) if limit is None else limit
    size = planned_bytes(right)
    if size is None or size > limit:
        return salted_lookup(left, right, keys, how, null_safe=null_safe, sample=sample)
    return null_safe_join(left, right, keys, how) if null_safe else left.join(right, keys, how)


def following_days_count(
    days: DataFrame, day: str, events: DataFrame, event_day: str, span: int, name: str
) -> DataFrame:
    """For each distinct day, the events on it and on the ``span`` days after it.

    Events are counted per day before anything is joined, and each day is expanded to its ``span + 1``
    calendar days, so the interval condition becomes an equality. No event in the window gives 0.
    """
    per_day = events.groupBy(F.col(event_day).alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    windows = days.select(day, F.explode_outer(F.sequence(F.col(day), F.date_add(day, span))).alias("_day"))
    return (
        windows.join(per_day, "_day", "left")
        .groupBy(day)
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias(name))
    )

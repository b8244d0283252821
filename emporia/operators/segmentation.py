"""Median segmentation: two measures per item, their ranks, lower medians and a quadrant label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.operators.joins import lookup
from emporia.operators.ranking import PLAIN_ROWS, global_rank, lower_median, shared_positions
from emporia.sources.shared import written


def quadrant(volume: Column, amount: Column, volume_mid: Column, amount_mid: Column, segments: Sequence[str]) -> Column:
    both, popular, premium, neither = segments
    much, dear = volume >= volume_mid, amount >= amount_mid
    return F.when(much & dear, both).when(much, popular).when(dear, premium).otherwise(neither)


def median_segmentation(
    items: DataFrame,
    volume: str,
    amount: str,
    by: Sequence[str] = (),
    *,
    medians: tuple[str, str] = ("mediane_volume", "mediane_ca"),
    segments: Sequence[str] | None = None,
    segment_name: str = "segment",
    total_rank: str | None = None,
    plain_rows: int = PLAIN_ROWS,
) -> DataFrame:
    """Ranks by ``volume`` and ``amount`` within each ``by`` group, the group medians and the quadrant.

    The aggregate is written once, and its exact row count decides whether one task may order a group. Beyond that
    all ranks and medians read one table of positions. Items without a group have no median and go.
    """
    by = list(by)
    held = items.dropna(subset=by) if by else items
    measures = [volume, amount]
    if total_rank:
        held = held.withColumn("_both", F.col(volume) + F.col(amount))
        measures.append("_both")
    items = written(held, "items")
    rows = items.count()
    sizes = {"rows": rows, "plain_rows": plain_rows}
    if rows > plain_rows:
        sizes["positions"] = shared_positions(items, measures, by)
    ranked = items
    for value, name in zip(measures, ("rang_volume", "rang_valeur", total_rank)):
        ranked = global_rank(ranked, value, name, by, source=items, **sizes)
    ranked = ranked.drop("_both")
    middle = lower_median(items, {volume: medians[0], amount: medians[1]}, by, **sizes)
    if not by:
        result = ranked.crossJoin(F.broadcast(middle))
    elif rows <= plain_rows:
        result = ranked.join(F.broadcast(middle), by)  # no more groups than counted rows
    else:
        result = lookup(ranked, written(middle, "medians"), by, "inner")
    if segments:
        label = quadrant(F.col(volume), F.col(amount), F.col(medians[0]), F.col(medians[1]), segments)
        result = result.withColumn(segment_name, label)
    return result

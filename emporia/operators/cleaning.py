"""Ingest operators: column names, duplicates, missing values and implausible values."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Accented letters that become plain ones.
ACCENTED, PLAIN = "ôâéèêÔÂÉÈÊ", "oaeeeOAEEE"
_ACCENTS = str.maketrans(ACCENTED, PLAIN)


#: Place of a row in its source; readers attach it, cleaning needs it to tell which row is first, and drops it.
POSITION = "rang_source"


def in_order(df: DataFrame, *columns: str) -> DataFrame:
    """Rows whose place in the source follows from columns of their own."""
    return df.withColumn(POSITION, F.struct(*columns))


def clean_name(name: str) -> str:
    words = re.sub("[ -]+", "_", name.translate(_ACCENTS).lower())
    return re.sub("[^a-z0-9_]", "", words)


def clean_column_names(df: DataFrame) -> DataFrame:
    """Lower-case ASCII names. Two columns that end up with one name are an error, not a silent loss."""
    names = [clean_name(name) for name in df.columns]
    clashes = [name for name, n in Counter(names).items() if n > 1]
    if clashes:
        raise ValueError(f"column names collide after cleaning: {', '.join(clashes)}")
    return df.toDF(*names)


def dedup_keep_first(df: DataFrame, keys: list[str], order_by: Iterable[str]) -> DataFrame:
    """First row per key in the order of the named columns; rows with a missing key go.

    Without an order there is no first row, so at least one order column must be there. Rows that tie in all of
    them are told apart by the remaining columns, so the kept row does not depend on the partitioning. The
    minimum of a struct is an aggregate: each task reduces its copies of a hot key before the shuffle, and Catalyst
    knows that the result is unique on the keys (it can then drop an unused left join to it).
    """
    first = [name for name in order_by if name not in keys]
    missing = [name for name in first if name not in df.columns]
    if missing or not first:
        raise ValueError(f"no order to find the first row per {', '.join(keys)}: {', '.join(missing) or 'no column'}")
    row = [*first, *[name for name in df.columns if name not in keys and name not in first]]
    present = df.where(" AND ".join(f"`{key}` IS NOT NULL" for key in keys))
    kept = present.groupBy(*keys).agg(F.min(F.struct(*row)).alias("_row"))
    return kept.select(*keys, "_row.*").select(*df.columns)


def fill_missing(df: DataFrame, columns: list[str], value: float = 0) -> DataFrame:
    return df.fillna(value, subset=columns)


def keep_non_negative(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows where every column is zero or more; a missing value fails too."""
    return df.where(" AND ".join(f"`{column}` >= 0" for column in columns))


def keep_present(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


Step = Callable[[DataFrame], DataFrame]


def first_per(*keys: str) -> Step:
    return lambda df: dedup_keep_first(df, list(keys), [POSITION])


def zero_for_missing(*columns: str) -> Step:
    return lambda df: fill_missing(df, list(columns))


def non_negative(*columns: str) -> Step:
    return lambda df: keep_non_negative(df, list(columns))


def present(*columns: str) -> Step:
    return lambda df: keep_present(df, list(columns))


# Cleaning steps per source table, applied in order. Order lines keep one line per order first, so an order
# whose first line is invalid has no line at all.
RECIPES: dict[str, list[Step]] = {
    "campagnes": [first_per("id_campagne"), non_negative("budget", "impressions", "clics", "conversions")],
    "clients": [first_per("id_client")],
    "commandes": [first_per("id_commande")],
    "details_commandes": [
        first_per("id_commande"),
        non_negative("quantite"),
        present("id_produit"),
    ],
    "entrepots_machines": [first_per("id"), zero_for_missing("temps_darret", "volume_traite")],
    "entrepots": [first_per("id_entrepot")],
    "posts": [first_per("id_post"), non_negative("volume_mentions")],
    "produits": [first_per("id"), non_negative("prix")],
    "promotions": [first_per("id_promotion")],
    "satisfaction": [first_per("id_satisfaction"), zero_for_missing("temps_reponse_support")],
}


def clean_table(name: str, df: DataFrame) -> DataFrame:
    """The recipe of a source table; its rows need their place in the source in :data:`POSITION`."""
    return reduce(lambda frame, step: step(frame), RECIPES[name], clean_column_names(df)).drop(POSITION)

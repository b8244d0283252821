"""Data checks on models: no missing value, no duplicate; one report row per check."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NOT_NULL, UNIQUE = "not_null", "unique"


class FailedChecks(ValueError):
    """Data that a check found wrong; another attempt would find the same."""


class Check(NamedTuple):
    model: str
    column: str
    test: str


def _both(model: str, column: str) -> list[Check]:
    return [Check(model, column, NOT_NULL), Check(model, column, UNIQUE)]


STAGING_CHECKS: list[Check] = [
    *_both("stg_clients", "id_client"),
    *_both("stg_campagnes", "id_campagne"),
    *_both("stg_commandes", "id_commande"),
    Check("stg_details_commandes", "id_commande", NOT_NULL),
    Check("stg_details_commandes", "id_produit", NOT_NULL),
    *_both("stg_entrepots_machines", "id_entrepot_machine"),
    Check("stg_entrepots_machines", "id_machine", NOT_NULL),
    Check("stg_entrepots_machines", "id_entrepot", NOT_NULL),
    *_both("stg_entrepots", "id_entrepot"),
    *_both("stg_posts", "id_post"),
    *_both("stg_produits", "id_produit"),
    *_both("stg_promotions", "id_promotion"),
    *_both("stg_satisfaction", "id_satisfaction"),
]


def _rows(model: str, counted: DataFrame, failures: dict[tuple[str, str], str]) -> DataFrame:
    """One report row per (column, test) from a one-row frame that holds each count in the named column."""
    entries = F.array(
        *[
            F.struct(
                F.lit(model).alias("model"),
                F.lit(column).alias("column"),
                F.lit(test).alias("test"),
                F.col(name).alias("failures"),
            )
            for (column, test), name in failures.items()
        ]
    )
    return counted.select(F.explode(entries).alias("_e")).select("_e.*")


def missing_values(model: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a missing value per column, all columns of a model in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(columns)])
    return _rows(model, counted, {(c, NOT_NULL): f"_{i}" for i, c in enumerate(columns)})


def key_values(model: str, df: DataFrame, column: str, *, not_null: bool) -> DataFrame:
    """Values that occur more than once and, on request, rows without a value, from one grouping.

    Missing values do not count as duplicates. A model that was deduplicated on the column is already
    partitioned by it, so the grouping needs no further shuffle.
    """
    present = F.col(column).isNotNull()
    counted = (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(
            F.count_if(present & (F.col("_n") > 1)).alias("_repeated"),
            F.coalesce(F.sum(F.when(~present, F.col("_n"))), F.lit(0)).cast("bigint").alias("_missing"),
        )
    )
    failures = {(column, NOT_NULL): "_missing"} if not_null else {}
    return _rows(model, counted, failures | {(column, UNIQUE): "_repeated"})


def run_checks(table: Callable[[str], DataFrame], checks: Iterable[Check] = STAGING_CHECKS) -> DataFrame:
    """Report with one row per check: model, column, test, failures."""
    checks = list(checks)
    parts = []
    for model in dict.fromkeys(c.model for c in checks):
        present = [c.column for c in checks if c.model == model and c.test == NOT_NULL]
        unique = [c.column for c in checks if c.model == model and c.test == UNIQUE]
        parts.extend(key_values(model, table(model), c, not_null=c in present) for c in unique)
        others = [c for c in present if c not in unique]
        if others:
            parts.append(missing_values(model, table(model), others))
    return reduce(DataFrame.unionByName, parts)


def require_clean(report: DataFrame) -> None:
    """Raise when a check failed. The report has one row per declared check."""
    failed = report.where(F.col("failures") > 0).collect()
    if failed:
        listed = ", ".join(f"{r['model']}.{r['column']} {r['test']}: {r['failures']}" for r in failed)
        raise FailedChecks(f"data checks failed: {listed}")

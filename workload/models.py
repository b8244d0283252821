"""Queries for the models: each builds its model from the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from emporia.plans.warehouse import Warehouse, build_order
from emporia.sources.projections import RawTables
from workload.oracle import MODEL_SQL, assemble

# The pair models run on the real products, and once more on sixty product families, which share more baskets.
PAIR_MODELS = (
    "v_produits_achetes_ensemble",
    "v_produits_achetes_ensemble_par_genre",
    "v_produits_achetes_ensemble_par_tranche_age",
)

Query = Callable[[SparkSession, str], DataFrame]


def warehouse(spark: SparkSession, folder: str, families: bool = False) -> Warehouse:
    return Warehouse(spark, RawTables(spark, folder, families), calendar=None)


def _query(name: str, families: bool = False) -> Query:
    return lambda spark, folder: warehouse(spark, folder, families).ref(name)


def queries() -> dict[str, Query]:
    made = {name: _query(name) for name in build_order()}
    return made | {f"{name}_familles": _query(name, True) for name in PAIR_MODELS}


def oracle_sql() -> dict[str, str]:
    made = {name: assemble(MODEL_SQL[name]) for name in build_order()}
    return made | {f"{name}_familles": assemble(MODEL_SQL[name], True) for name in PAIR_MODELS}

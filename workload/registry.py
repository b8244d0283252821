"""Named queries with optional checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from emporia.plans.warehouse import Warehouse
from emporia.sources.projections import RawTables
from workload.oracle import assemble

Query = Callable[[SparkSession, str], DataFrame]


class Data:
    """Source tables and models over one test data folder."""

    def __init__(self, spark: SparkSession, folder: str, families: bool = False) -> None:
        self.spark, self.folder = spark, folder
        self.raw = RawTables(spark, folder, families)
        self.warehouse = Warehouse(spark, self.raw, calendar=None)

    def __call__(self, name: str) -> DataFrame:
        return self.warehouse.ref(name)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, *, families: bool = False):
    """Register a function of :class:`Data` as a query; ``sql`` may use the models and raw tables by name."""

    def register(make: Callable[[Data], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is declared twice")
        QUERIES[name] = lambda spark, folder: make(Data(spark, folder, families))
        if sql is not None:
            ORACLES[name] = assemble(sql, families)
        return make

    return register

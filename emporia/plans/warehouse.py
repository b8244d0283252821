"""Model registry: each model is a function of other models, built in dependency order."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.operators.cleaning import clean_table
from emporia.sources.store import Layout, Version
from emporia.sources.tables import SCHEMAS

#: Column by which a large order fact lies in folders; it is the month of the order.
ORDER_MONTH = "mois_commande"
CALENDAR = ("2019-01-01", "2025-12-30")  # fixed value: 2,556 days, the last day of 2025 is not among them
CALENDAR_SPAN = "calendar_span"


@dataclass(frozen=True)
class Model:
    name: str
    refs: tuple[str, ...]
    build: Callable[..., DataFrame]
    table: bool = False


MODELS: dict[str, Model] = {}


def model(
    name: str, *refs: str, table: bool = False
) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    """Register a model; its function receives the DataFrames of ``refs`` in order."""

    def register(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        if name in MODELS:
            raise ValueError(f"model {name} is declared twice")
        MODELS[name] = Model(name, refs, build, table)
        return build

    return register


def build_order(names: Iterable[str] | None = None) -> list[str]:
    """Models in an order where every model follows the ones it reads."""
    _load_models()
    wanted, todo = set(), list(names or MODELS)
    while todo:
        name = todo.pop()
        if name in wanted or name in SCHEMAS or name == CALENDAR_SPAN:
            continue
        if name not in MODELS:
            raise KeyError(f"unknown model {name}")
        wanted.add(name)
        todo.extend(MODELS[name].refs)
    graph = {name: {r for r in MODELS[name].refs if r in wanted} for name in wanted}
    return list(TopologicalSorter(graph).static_order())


def _load_models() -> None:
    from emporia.plans import baskets, calendars, logistics, marts, promotions, sales, satisfaction, social, staging

    del baskets, calendars, logistics, marts, promotions, sales, satisfaction, social, staging


class Warehouse:
    """Models over a set of raw source tables.

    Most models are lazy plans. Those that rank, take medians or pair products (segmentations, product pairs,
    sensitivity to promotions, delays) write intermediate tables while they are built, so asking for them runs
    jobs. With ``version`` set, the cleaned sources and the models declared as tables are written to it once, in the
    named ``layouts``, and read back, which is how the shared fact and dimensions are meant to be used on large data.
    """

    def __init__(
        self,
        spark: SparkSession,
        sources: Mapping[str, DataFrame],
        *,
        version: Version | None = None,
        calendar: tuple[str, str] | None = CALENDAR,
        layouts: Mapping[str, Layout] | None = None,
    ) -> None:
        """``calendar`` is the first and last day of the date dimension; ``None`` takes those of the orders."""
        _load_models()
        self._calendar = calendar
        self.spark = spark
        self._sources = sources
        self._version = version
        self._layouts = layouts or {}
        self._built: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, version: Version, calendar: tuple[str, str] | None = CALENDAR) -> Warehouse:
        """A warehouse that reads the cleaned sources and table models of a written version."""
        made = cls(version.store.spark, {}, calendar=calendar)
        for name in version.tables:
            known = name.removeprefix("sources/")
            if known in SCHEMAS or known in MODELS:
                made._built[known] = made._plain(version.table(name))
        return made

    @staticmethod
    def _plain(frame: DataFrame) -> DataFrame:
        return frame.drop(ORDER_MONTH)

    def source(self, name: str) -> DataFrame:
        """A raw table after the ingest cleaning of its recipe."""
        if name not in self._sources:
            raise ValueError(f"no data found for source table: {name}")
        return self._stored(clean_table(name, self._sources[name]), f"sources/{name}")

    def _stored(self, frame: DataFrame, name: str) -> DataFrame:
        """Written to the version and read back; unchanged without one."""
        if self._version is None:
            return frame
        layout = self._layouts.get(name, Layout())
        if ORDER_MONTH in layout.partition_by:
            frame = frame.withColumn(ORDER_MONTH, F.date_format("date_commande", "yyyy-MM"))
        return self._plain(self._version.write(name, frame, layout))

    def _calendar_span(self) -> DataFrame:
        if self._calendar is None:
            return self.ref("stg_commandes").agg(
                F.min("date_commande").alias("first_day"), F.max("date_commande").alias("last_day")
            )
        first, last = self._calendar
        return self.spark.range(1).select(
            F.to_date(F.lit(first)).alias("first_day"), F.to_date(F.lit(last)).alias("last_day")
        )

    def ref(self, name: str) -> DataFrame:
        if name == CALENDAR_SPAN:
            return self._calendar_span()
        if name in self._built:
            return self._built[name]
        if name not in MODELS:
            if name in SCHEMAS:
                self._built[name] = self.source(name)
                return self._built[name]
            raise KeyError(f"unknown model {name}")
        found = MODELS[name]
        frame = found.build(*[self.ref(r) for r in found.refs])
        self._built[name] = frame = self._stored(frame, name) if found.table else frame
        return frame

    def build(self, *names: str) -> dict[str, DataFrame]:
        return {name: self.ref(name) for name in build_order(names or None)}

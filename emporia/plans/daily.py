"""The daily job: clean the sources, check them, write the star schema and the indicators as one new version."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import copy_context

from pyspark.sql import DataFrame, SparkSession

from emporia.plans.checks import FailedChecks, require_clean, run_checks
from emporia.plans.warehouse import CALENDAR, MODELS, ORDER_MONTH, Warehouse, build_order
from emporia.session import RUNTIME
from emporia.sources.shared import job_folder, planned_bytes
from emporia.sources.store import DAY, Layout, Store, Version
from emporia.sources.tables import SCHEMAS

AT_ONCE = 4  # independent tables written at the same time, so that small ones do not leave the cluster idle
#: Size of the orders from which the tables with an order id are bucketed on it, and the fact lies in months.
LAYOUT_BYTES = 1 << 30
#: Size of the orders in a bucket.
BUCKET_BYTES = 64 << 20
_ORDER_TABLES = ("sources/commandes", "sources/details_commandes", "sources/satisfaction", "mrt_fct_satisfaction")
_ORDER_KEY = "id_commande"

_settings_lock = threading.Lock()
_settings: dict[int, tuple[int, dict[str, str | None]]] = {}


@contextmanager
def runtime_settings(spark: SparkSession) -> Iterator[None]:
    """The settings that the plans are made for; the last of the jobs that run in a session puts the old ones back."""
    with _settings_lock:
        jobs, before = _settings.get(id(spark), (0, {}))
        if not jobs:
            before = {key: spark.conf.get(key, None) for key in RUNTIME}
            for key, value in RUNTIME.items():
                spark.conf.set(key, value)
        _settings[id(spark)] = (jobs + 1, before)
    try:
        yield
    finally:
        with _settings_lock:
            jobs, before = _settings.pop(id(spark))
            if jobs > 1:
                _settings[id(spark)] = (jobs - 1, before)
            else:
                for key, value in before.items():
                    if value is None:
                        spark.conf.unset(key)
                    else:
                        spark.conf.set(key, value)


def order_layouts(orders: DataFrame, layout_bytes: int = LAYOUT_BYTES) -> dict[str, Layout]:
    """Buckets on the order id for all tables that have one, so that they join without an exchange, and months for the
    fact. Small tables would only fall into many small files and keep the plain layout. The fact has a file for each
    month and bucket, so there are no more buckets than the size of the orders asks for, or the cores."""
    size = planned_bytes(orders) or 0
    if size < layout_bytes:
        return {}
    buckets = max(min(-(-size // BUCKET_BYTES), 10_000), orders.sparkSession.sparkContext.defaultParallelism)
    made = {name: Layout(bucket_by=_ORDER_KEY, buckets=buckets) for name in _ORDER_TABLES}
    return made | {"mrt_fct_commandes": Layout((ORDER_MONTH,), _ORDER_KEY, buckets)}


def _at_once(work: Callable[[str], object], names: Iterable[str]) -> None:
    """``work`` on several names at a time; its threads belong to the caller's job."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        for each in [pool.submit(copy_context().run, work, name) for name in names]:
            each.result()


def _write_all(version: Version, warehouse: Warehouse, indicators: list[str]) -> None:
    tables = [name for name in build_order() if MODELS[name].table]
    later = [name for name in tables if any(r in tables for r in MODELS[name].refs)]
    _at_once(warehouse.ref, SCHEMAS)
    require_clean(run_checks(warehouse.ref))
    _at_once(warehouse.ref, [name for name in tables if name not in later])
    for name in later:
        warehouse.ref(name)
    for name in indicators:
        version.write(f"indicators/{name}", warehouse.ref(name))


def run_daily(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    store: str,
    *,
    calendar: tuple[str, str] | None = CALENDAR,
    indicators: Iterable[str] = (),
    retries: int = 1,
    grace: float = DAY,
    layout_bytes: int = LAYOUT_BYTES,
) -> Warehouse:
    """Replace the cleaned sources, every table model and the named indicators below ``store``, all together.

    All tables are written as a new version of the store (:mod:`emporia.sources.store`), which counts from the moment
    it is complete and checked. A run that fails or is killed at any step leaves all old tables as they were; after an
    error it is tried ``retries`` times more, but not after a failed data check. Runs at the same time do not touch
    each other. Versions that were replaced more than ``grace`` seconds ago go. Intermediate tables are removed at the
    end, also after an error. ``calendar`` is that of :class:`Warehouse`. The result reads the written version.
    """
    held, wanted = Store(spark, store), list(indicators)
    layouts = order_layouts(sources["commandes"], layout_bytes) if "commandes" in sources else {}
    for left in range(retries, -1, -1):
        try:
            with runtime_settings(spark), job_folder(spark), held.new_version() as version:
                _write_all(version, Warehouse(spark, sources, version=version, calendar=calendar, layouts=layouts), wanted)
            break
        except FailedChecks:
            raise
        except Exception:
            if not left:
                raise
    held.clean(grace)
    return Warehouse.of(version, calendar)

"""Versioned tables: a run writes a version of all its tables, and one small manifest makes them the current ones.

Layout below the root: ``_versions/<id>/<table>`` and ``_manifests/<number>-<id>.json``. A version counts from the
moment its manifest is whole; the current one is that of the highest manifest that can be read to its end. Nothing is
renamed, so it holds on object stores too, and a run that dies at any step leaves the tables before it as they were.
Runs at the same time write versions of their own; the later manifest wins as a whole. A reader resolves the manifest
once and keeps its version, which stays for a grace time after it was replaced.

Tables that name buckets are written as such and read through the session's catalog, because Spark keeps buckets there
and not in the files; joins and groups on the bucket key then need no exchange.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from emporia.sources.shared import child_names, exists, read_text, remove, write_text

VERSIONS, MANIFESTS = "_versions", "_manifests"
DAY = 86_400.0


@dataclass(frozen=True)
class Layout:
    """How a table lies: partition columns, and a number of buckets by a key."""

    partition_by: tuple[str, ...] = ()
    bucket_by: str | None = None
    buckets: int = 0


@dataclass(frozen=True)
class Entry:
    """A written table: its schema as JSON, its format and its layout."""

    schema: str
    fmt: str = "parquet"
    layout: Layout = field(default_factory=Layout)

    def as_json(self) -> dict:
        at = self.layout
        return {"schema": self.schema, "fmt": self.fmt, "partition_by": list(at.partition_by), "bucket_by": at.bucket_by, "buckets": at.buckets}

    @staticmethod
    def of(held: dict) -> Entry:
        return Entry(held["schema"], held["fmt"], Layout(tuple(held["partition_by"]), held["bucket_by"], held["buckets"]))


@dataclass(frozen=True)
class Manifest:
    number: int
    version: str
    written_at: float
    tables: dict[str, Entry]


class Version:
    """One state of the tables. ``write`` adds to a version that is not committed yet."""

    def __init__(self, store: Store, name: str, tables: dict[str, Entry]) -> None:
        self.store, self.name, self.tables = store, name, tables

    def path(self, table: str) -> str:
        return f"{self.store.root}/{VERSIONS}/{self.name}/{table}"

    def write(self, table: str, df: DataFrame, layout: Layout | None = None, fmt: str = "parquet") -> DataFrame:
        """Write ``df`` as ``table`` of this version and return a scan of it.

        A bucket is written by one task: the others would each leave a file of their own in it, and with partition
        columns one in each of its partitions, however few rows they hold.
        """
        layout = layout or Layout()
        if layout.bucket_by:
            df = df.repartition(layout.buckets, layout.bucket_by)
        writer = df.write.format(fmt).mode("overwrite")  # what an attempt before left here
        if fmt == "csv":
            writer = writer.option("header", True)
        if layout.partition_by:
            writer = writer.partitionBy(*layout.partition_by)
        if layout.bucket_by:
            catalog_name = self._catalog_name(table)
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {catalog_name}")
            writer = writer.option("path", self.path(table)).bucketBy(layout.buckets, layout.bucket_by)
            writer.sortBy(layout.bucket_by).saveAsTable(catalog_name)
        else:
            writer.save(self.path(table))
        named = [f for f in df.schema.fields if f.name not in layout.partition_by]
        named += [df.schema[c] for c in layout.partition_by]  # a scan has the partition columns last
        self.tables[table] = Entry(T.StructType(named).json(), fmt, layout)
        return self.table(table)

    def _catalog_name(self, table: str) -> str:
        told = uuid.uuid5(uuid.NAMESPACE_URL, self.path(table)).hex
        return f"emporia_{told}"

    def table(self, table: str) -> DataFrame:
        if table not in self.tables:
            raise ValueError(f"no table {table} in {self.store.root}")
        spark, entry = self.store.spark, self.tables[table]
        if entry.layout.bucket_by:
            return self._bucketed(table, entry)
        reader = spark.read.format(entry.fmt)
        if entry.fmt == "csv":
            return reader.option("header", True).load(self.path(table))
        return reader.schema(T.StructType.fromJson(json.loads(entry.schema))).load(self.path(table))

    def _bucketed(self, table: str, entry: Entry) -> DataFrame:
        spark, name, at = self.store.spark, self._catalog_name(table), entry.layout
        if not spark.catalog.tableExists(name):
            fields = T.StructType.fromJson(json.loads(entry.schema)).fields
            listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            partitions = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in at.partition_by)})" if at.partition_by else ""
            spark.sql(
                f"CREATE TABLE {name} ({listed}) USING {entry.fmt} {partitions} CLUSTERED BY (`{at.bucket_by}`) "
                f"SORTED BY (`{at.bucket_by}`) INTO {at.buckets} BUCKETS LOCATION '{self.path(table)}'"
            )
            if at.partition_by:
                spark.sql(f"MSCK REPAIR TABLE {name}")
        return spark.table(name)


class Store:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def manifests(self) -> list[Manifest]:
        """All manifests that are whole, the newest first."""
        found = []
        for name in sorted(child_names(self.spark, f"{self.root}/{MANIFESTS}"), reverse=True):
            try:
                held = json.loads(read_text(self.spark, f"{self.root}/{MANIFESTS}/{name}"))
            except ValueError:  # its writer died, or is still at it
                continue
            tables = {k: Entry.of(v) for k, v in held["tables"].items()}
            found.append(Manifest(held["number"], held["version"], held["written_at"], tables))
        return found

    def current(self) -> Version | None:
        """The version that counts now; later runs do not change what it reads."""
        newest = self.manifests()
        return Version(self, newest[0].version, dict(newest[0].tables)) if newest else None

    def table(self, name: str) -> DataFrame:
        version = self.current()
        if version is None:
            raise ValueError(f"no tables in {self.root}")
        return version.table(name)

    def commit(self, version: Version, now: Callable[[], float] = time.time) -> Manifest:
        """Make ``version`` the current one by a manifest with a number above all others and a name of its own."""
        numbers = [int(n.split("-")[0]) for n in child_names(self.spark, f"{self.root}/{MANIFESTS}")]
        made = Manifest(max(numbers, default=0) + 1, version.name, now(), dict(version.tables))
        told = {"number": made.number, "version": made.version, "written_at": made.written_at}
        told["tables"] = {k: v.as_json() for k, v in made.tables.items()}
        write_text(self.spark, f"{self.root}/{MANIFESTS}/{made.number:012d}-{version.name}.json", json.dumps(told))
        return made

    @contextmanager
    def new_version(self) -> Iterator[Version]:
        """A version that is committed at the end; after an error nothing of it is left and nothing has changed."""
        version = Version(self, f"{int(time.time() * 1000):014d}-{uuid.uuid4().hex}", {})
        try:
            yield version
        except BaseException:
            self._forget(version.name, version.tables)
            raise
        self.commit(version)

    def _forget(self, name: str, tables: dict[str, Entry]) -> None:
        version = Version(self, name, tables)
        for table, entry in tables.items():
            if entry.layout.bucket_by:
                self.spark.sql(f"DROP TABLE IF EXISTS {version._catalog_name(table)}")
        remove(self.spark, f"{self.root}/{VERSIONS}/{name}")

    def clean(self, grace: float = DAY, now: Callable[[], float] = time.time) -> list[str]:
        """Remove versions that were replaced more than ``grace`` seconds ago, and what killed runs left that long ago.

        A version's name begins with the time of its start in milliseconds.
        """
        manifests = self.manifests()
        until = {}
        for newer, older in zip(manifests, manifests[1:], strict=False):
            until[older.version] = newer.written_at
        gone = []
        for name in child_names(self.spark, f"{self.root}/{VERSIONS}"):
            if manifests and name == manifests[0].version:
                continue
            left = until.get(name, int(name.split("-")[0]) / 1000)
            if now() - left > grace:
                tables = next((m.tables for m in manifests if m.version == name), {})
                number = next((m.number for m in manifests if m.version == name), None)
                if number is not None:  # first the manifest: no reader may find a version that is half gone
                    remove(self.spark, f"{self.root}/{MANIFESTS}/{number:012d}-{name}.json")
                self._forget(name, tables)
                gone.append(name)
        return gone


def is_store(spark: SparkSession, root: str) -> bool:
    return exists(spark, f"{root.rstrip('/')}/{MANIFESTS}")

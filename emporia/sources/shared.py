"""Written intermediate tables in the folder that every executor can read.

A written table cuts lineage, survives the loss of executors and has an exact size. The folder is the one
that the cluster names in ``spark.checkpoint.dir``; only a local session without that setting gets a
temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None
_job_folder: ContextVar[str | None] = ContextVar("job_folder", default=None)


def shared_folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can read")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="emporia-")
    return _local_folder


def new_path(spark: SparkSession, label: str) -> str:
    """A path that nothing else uses, in the folder of the job at hand or else of the application."""
    top = _job_folder.get() or f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"
    return f"{top}/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it; nothing happens where there is none."""
    files, place = _file_system(spark, path)
    files.delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none where there is no folder."""
    files, place = _file_system(spark, path)
    return [x.getPath().getName() for x in files.listStatus(place)] if files.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str:
    files, place = _file_system(spark, path)
    stream = files.open(place)
    try:
        return str(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small file; one that is there already is an error."""
    files, place = _file_system(spark, path)
    stream = files.create(place, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


@contextmanager
def job_folder(spark: SparkSession) -> Iterator[str]:
    """Tables written inside go to a folder of the job, which is removed at the end, also after an error.

    The folder belongs to the calling context, so jobs at the same time have folders of their own; threads that work
    for a job run in a copy of its context.
    """
    path = new_path(spark, "job")
    token = _job_folder.set(path)
    try:
        yield path
    finally:
        _job_folder.reset(token)
        remove(spark, path)


def written(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet and return a scan of it; ``path`` may name a place outside the job's folder."""
    spark = df.sparkSession
    path = path or new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def planned_bytes(df: DataFrame) -> int | None:
    """Size estimate of the optimised plan, the same figure Catalyst compares with its broadcast limit."""
    java = getattr(df, "_jdf", None)
    if java is None:
        return None
    return int(str(java.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; zero when broadcasting is switched off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").strip().lower()
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    text = text[:-1] if text.endswith("b") else text
    scale = units.get(text[-1:], 1)
    return max(int(text[:-1] if scale > 1 else text) * scale, 0)

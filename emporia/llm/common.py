"""Small helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space that separates words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns by exact spelling.

    Columns that repeat a name or differ from one only in case do not clash, and all others are left behind.
    """
    held = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return held.select(*[F.col(f"_c{df.columns.index(name)}").alias(name) for name in names])


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, UPPER, LOWER)


def held_out(doc_id: Column, parts: int = 4) -> Column:
    """The part of the documents that no model learns from; a missing id is held out too."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == 2, F.lit(True))


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def parts_for(df: DataFrame, rows: int, per_part: int) -> int:
    """Parts for work dealt out by an explicit number: by size, and enough to occupy the cluster."""
    return max(-(-rows // per_part), 2 * shuffle_partitions(df))

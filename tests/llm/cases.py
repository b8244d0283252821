"""Small tables with the awkward rows that every operator must stand."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names clash with each other, with the table's and with names that operators use.
CLASHES = {"TEXT": "'x'", "Doc_Id": "7", "keep_id": "1", "fp": "2", "version": "3", "part": "4", "_id": "5", "taken": "6"}
LONG = " ".join(f"word{i % 977}" for i in range(60_000))


def odd_rows() -> list[tuple]:
    rows = [
        (900001, None, None, None, None),
        (900002, "", "en", "src1", 0),
        (900003, " \t\n\r\x0b\x0c ", "en", None, 7),
        (900004, LONG, "en", "src1", len(LONG)),
        (900005, LONG, "en", "src1", len(LONG)),
        (900006, "\n\n\n", "de", "src2", 3),
        (900007, "12 34 -- !!", None, "src2", 11),
        (900008, "tie one two three", "en", "src3", 17),
        (900008, "tie one two three", "en", "src3", 17),
        (900008, "tie one two four", "en", "src3", 16),
        (None, "no id here", "fr", "src3", 10),
        (None, "no id here", "fr", "src3", 10),
        (None, None, None, None, None),
        (900009, "ÉKſ ÉCOLE Straße \U0001f600 数字", "fr", "src4", 20),
        (-5, "TIE  one\ttwo\nthree", "en", "src3", 18),
    ]
    return rows


def documents(spark, folder: str, limit: int = 60):
    """Rows of the smallest table beside the awkward ones."""
    real = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").limit(limit)
    return real.select("doc_id", "text", "lang", "source", "n_chars").union(spark.createDataFrame(odd_rows(), SCHEMA))


def with_clashes(df):
    """The same rows under columns of which some differ only in case, and one repeats a name."""
    made = df
    from pyspark.sql import functions as F

    extra = [F.expr(v).alias(k) for k, v in CLASHES.items()]
    return made.select("*", *extra, F.lit("again").alias("text"))


def plain(rows) -> list[tuple]:
    """Sorted rows, nulls first."""
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x) if not isinstance(x, list) else (True, str(x)) for x in r))

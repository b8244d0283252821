"""The corpus pipeline: five stages, each an operator of ``emporia.llm``, written and read again between them.

All stages take documents with any columns beside ``doc_id, text, lang, source``, whatever their names, and give back
those columns. Null texts count as empty, rows may repeat and ids may be missing, and an empty table stays empty. A very
long text is one row like any other; what each stage holds of it says the docstring of its operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emporia.llm import decontaminate, langid, line_dedup, mixing, simhash
from emporia.llm.common import shuffle_partitions
from emporia.sources.shared import job_folder, new_path, remove, written

#: Languages that stay; ``None`` stands for all that the documents teach.
LANGUAGES: tuple[str, ...] | None = None
#: Least share of a text's n-grams that its language's filter has to contain. Texts of the learned languages have 0.5 and
#: more, texts of other languages or scripts and random letters next to nothing.
MIN_SCORE = 0.3
#: Rows that repeat are made from one in parts of so many.
_REPEATS = 1000


def document_key(doc_id: Column, version: Column) -> Column:
    """The id and the 64-bit hash of the text as one value."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), version)


class _Rows:
    """All columns of a table under names that cannot clash, with those that a stage works on by position."""

    def __init__(self, docs: DataFrame) -> None:
        self.names = docs.columns
        self.held = docs.toDF(*[f"_c{i}" for i in range(len(self.names))])

    def name(self, column: str) -> str:
        return f"_c{self.names.index(column)}"

    def keyed(self) -> DataFrame:
        """The rows with ``_key`` beside them, which tells different documents apart and is never null."""
        return self.held.withColumn("_key", document_key(F.col(self.name("doc_id")), F.xxhash64(self.name("text"))))

    def back(self, rows: DataFrame) -> DataFrame:
        """The table's own columns under their own names."""
        return rows.select(*self.held.columns).toDF(*self.names)

    def with_text(self, rows: DataFrame) -> DataFrame:
        """As :meth:`back`, after ``rows`` got a new text: its length follows."""
        if "n_chars" in self.names:
            rows = rows.withColumn(self.name("n_chars"), F.length(self.name("text")).cast("long"))
        return self.back(rows)


def language_id(
    spark: SparkSession,
    docs: DataFrame,
    sf_dir: str,
    languages: tuple[str, ...] | None = LANGUAGES,
    min_score: float = MIN_SCORE,
) -> DataFrame:
    """Documents in one of ``languages`` with a score of at least ``min_score``; a missing ``lang`` gets the prediction.

    Null and empty texts and those without a letter go. The filters learn from the documents with a ``lang`` that are
    not held out. Where there are none nothing tells languages apart, and all texts with a letter stay.
    """
    rows = _Rows(docs)
    text, lang = rows.name("text"), rows.name("lang")
    model = langid.train(docs)
    if not model.languages:
        return rows.back(rows.held.filter(F.col(text).rlike("\\p{L}")))
    # so marked, Spark predicts once for the filter and the column together
    told = rows.held.withColumn("_told", langid.predictor(model).asNondeterministic()(text))
    wanted = [x for x in model.languages if languages is None or x in languages]
    kept = told.filter(F.col("_told.lang_pred").isin(wanted) & (F.col("_told.score") >= min_score))
    return rows.back(kept.withColumn(lang, F.coalesce(lang, "_told.lang_pred")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that at least ten documents share.

    Empty lines are no lines to count, so a null or empty text stays as it is. Rows without an id count as one document;
    rows that repeat lose the same lines and all stay. A document may end up empty.
    """
    rows = _Rows(docs)
    bitmaps = line_dedup.line_bitmaps(docs, min_docs=10, min_chars=1)
    bitmaps = bitmaps.select(document_key(F.col("doc_id"), F.col("version")).alias("_key"), F.col("keep_bits").alias("_bits"))
    text = rows.name("text")
    joined = rows.keyed().join(bitmaps, "_key", "left")
    return rows.with_text(joined.withColumn(text, line_dedup.apply_bitmap(text, "_bits")["kept"]))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    Texts without words are one group. Of rows that repeat one stays; rows without an id go before those with one only
    where a group has no other.
    """
    rows = _Rows(docs)
    stay = simhash.representatives(docs, shingle_words=3, distance=2)
    stay = stay.select(document_key(F.col("doc_id"), F.col("version")).alias("_key"))
    # repeats go before the shuffle of the join, so one row with many copies is no hot key
    return rows.back(rows.keyed().dropDuplicates(["_key"]).join(stay, "_key", "left_semi"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the passages cut out that they share with the benchmark.

    Every document stays, a null text as it is; one that is nothing but a passage becomes empty. Rows that repeat are cut
    alike. With an empty benchmark nothing changes.
    """
    rows = _Rows(docs)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    text = rows.name("text")
    cleaned = decontaminate.remove_contamination(rows.held.withColumnRenamed(text, "text"), benchmark)
    return rows.with_text(cleaned.withColumnRenamed("text", text))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with their words, their source's target and the words taken of each.

    Documents without words go, as the mix takes none of them. A null source is a source. Rows that repeat are separate
    documents of the mix: as many of them stay as it takes, each with its own words taken.
    """
    rows = _Rows(docs)
    source = F.col(rows.name("source"))
    by_source = lambda key, name: F.concat_ws(":", key, F.coalesce(F.concat(F.lit("s"), name), F.lit("-")))
    mixed = mixing.mix(docs, weights=(1, 2, 3), repeats=3).filter(F.col("taken") > 0)
    key = by_source(document_key(F.col("doc_id"), F.col("version")), F.col("source"))
    shares = mixed.groupBy(key.alias("_key"), "size", "source_size", "target", "taken").agg(F.count(F.lit(1)).alias("_rows"))
    # equal rows may be taken differently: a key has a share for each number of copies and one that the budget cut
    several = Window.partitionBy("_key")
    shares = written(shares.withColumn("_all", F.sum("_rows").over(several)), "shares")
    more = ["size", "source_size", "target", "taken"]
    renamed = {c: f"_{c}" for c in more}
    keyed = rows.keyed().withColumn("_key", by_source(F.col("_key"), source))
    once = shares.filter(F.col("_all") == 1).withColumnsRenamed(renamed)
    made = keyed.join(once, "_key").select(*rows.held.columns, *renamed.values())
    repeated = shares.filter(F.col("_all") > 1)
    if not repeated.isEmpty():
        # one row stands for all that are equal to it and is made again as often as the mix takes it, part by part
        parts = repeated.withColumn("_first", F.explode(F.sequence(F.lit(0), F.col("_rows") - 1, F.lit(_REPEATS))))
        parts = parts.withColumn("_n", F.least(F.col("_rows") - F.col("_first"), F.lit(_REPEATS))).withColumnsRenamed(renamed)
        dealt = keyed.dropDuplicates(["_key"]).join(parts, "_key").repartition(shuffle_partitions(docs), "_key", "_first")
        again = dealt.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
        made = made.unionByName(again.select(*made.columns))
    return made.select(*rows.held.columns, *renamed.values()).toDF(*rows.names, *more)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
]

# Learned filters, 64-bit XXH64 fingerprints and a search index have no form in SQL; tests hold the rows against a
# brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written and read again as the next one's.

    What a stage writes on its way goes when its rows are written, and those go when the next stage's are.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = new_path(spark, name)
        with job_folder(spark):
            docs = written(stage(spark, docs, sf_dir), name, path)
        if before is not None:
            remove(spark, before)
        before = path
    return docs

"""The operators applied to whole tables with production parameters, and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.llm import (
    checking_sql,
    decontaminate,
    exact_dedup,
    hard_negatives,
    html_extract,
    langid,
    line_dedup,
    lm_score,
    mixing,
    secret_scan,
    simhash,
    spelling,
    toxicity,
    url_filter,
)
from emporia.llm.common import pick
from emporia.sources.shared import job_folder, new_path, written

# Verdict, host and path of each rule.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, folder, "documents"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.simhash_groups(_table(spark, folder, "documents"), shingle_words=3, distance=2)
    return found.select("doc_id", simhash.hex_print(F.col("fp")).alias("fingerprint"), "component_id", "copies")


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    found = mixing.mix(_table(spark, folder, "documents"), weights=(1, 2, 3), repeats=3)
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(_table(spark, folder, "documents"))


def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated")
    )


def op7_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.main_text(_table(spark, folder, "pages"))


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(_table(spark, folder, "pages"), URL_RULES)


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secrets(_table(spark, folder, "documents"))


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.line_dedup(_table(spark, folder, "documents"), min_docs=10, min_chars=1)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    found = spelling.variants(_table(spark, folder, "documents"), min_chars=7, min_count=2, every=31, times=10)
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = pick(_table(spark, folder, "embeddings"), "vec_id", "embedding", "label")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.lm_scores(_table(spark, folder, "documents"))


def _tidy(make: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query with its result as a table, and without what it wrote on the way."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        path = new_path(spark, make.__name__)
        with job_folder(spark):
            return written(make(spark, folder), make.__name__, path)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = [
        op1_exact_dedup,
        op2_toxicity,
        op3_simhash,
        op4_mixing,
        op5_language,
        op6_decontaminate,
        op7_main_text,
        op8_url_filter,
        op9_secrets,
        op10_line_dedup,
        op11_spelling,
        op12_hard_negatives,
        op13_lm_score,
    ]
    return {f.__name__: _tidy(f) for f in made}


def oracle_sql() -> dict[str, str]:
    """Learned models and 64-bit XXH64 hashes have no form in SQL; tests hold those queries against brute force."""
    return {
        "op1_exact_dedup": checking_sql.EXACT,
        "op4_mixing": checking_sql.MIXING,
        "op6_decontaminate": checking_sql.DECONTAMINATION,
        "op9_secrets": checking_sql.secrets(),
        "op10_line_dedup": checking_sql.LINES,
        "op11_spelling": checking_sql.SPELLING,
        "op12_hard_negatives": checking_sql.NEGATIVES,
    }

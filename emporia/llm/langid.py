"""Language identification with bit-sliced Bloom filters over character n-grams.

For every language a Bloom filter holds the n-grams that are typical of it. The filters are stored as one array of
bit masks: row ``r`` has one bit per language, so the AND of an n-gram's rows is the set of all languages whose
filter contains it, found in one look. A text's score per language is the number of its n-grams that the mask has,
corrected for the false positives that the filter's fill makes likely; the highest score decides.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import held_out, pick
from emporia.llm.subwords import WordTable, gram_hashes
from emporia.sources.shared import written

SIZES = (1, 2, 3, 4)
#: Labelled documents per language that the n-gram counts are taken from, in expectation.
SAMPLE_PER_LANGUAGE = 3000
#: Smallest share of a language's n-grams that makes one typical, so a language has at most 1 / MIN_SHARE of them.
MIN_SHARE = 2e-5
#: Part of the largest share in any language that an n-gram must reach to be typical of a language too.
PART_OF_MOST = 0.25
#: Languages that a model may have: their sample rates and filters are held by every task.
MAX_LANGUAGES = 4096
HASHES = 3
ROWS_PER_GRAM = 8
UNKNOWN = "und"
_CACHED_WORDS, _ROWS = 300_000, 1000
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    """``rows[r]`` are the language bits of filter row ``r``, ``words`` 64-bit words for any number of languages."""

    languages: list[str]
    rows: np.ndarray
    false_positive: np.ndarray
    prior: int

    def places(self, hashes: np.ndarray) -> np.ndarray:
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        turns = [hashes + np.uint64(i) * step for i in range(HASHES)]
        return np.stack(turns).astype(np.uint64) % np.uint64(len(self.rows))

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        """Bits of all languages that contain each n-gram."""
        return np.bitwise_and.reduce(self.rows[self.places(hashes).astype(np.int64)], axis=0)

    def counts(self, words: list[str]) -> np.ndarray:
        """For each word the number of its n-grams, then for each language the number that its filter contains."""
        word, hashes = gram_hashes(words, SIZES)
        masks = self.masks(hashes)
        out = np.zeros((len(words), len(self.languages) + 1))
        out[:, 0] = np.bincount(word, minlength=len(words))
        for i in range(len(self.languages)):
            has = (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            out[:, i + 1] = np.bincount(word, has.astype(np.float64), len(words))
        return out


def count_grams(docs: DataFrame, per_language: int) -> DataFrame:
    """``lang, gram, n`` (n-grams by their hash) over a bounded sample of labelled documents, drawn by a hash of the id."""
    known = docs.filter(F.col("lang").isNotNull())
    sizes = written(known.groupBy("lang").agg(F.count(F.lit(1)).alias("docs")), "language-sizes")
    if sizes.count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} values of lang to learn")
    part = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1_000_000)) / 1_000_000
    rated = known.join(F.broadcast(sizes), "lang")  # at most MAX_LANGUAGES rows
    drawn = rated.filter(part < F.lit(per_language) / F.col("docs")).select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                words.setdefault(lang, Counter()).update(_WORD.findall((text or "").lower()))
            if sum(map(len, words.values())) > _CACHED_WORDS:
                yield _gram_rows(words)
                words = {}
        yield _gram_rows(words)

    counted = drawn.mapInPandas(count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _gram_rows(words: dict[str, Counter]) -> pd.DataFrame:
    parts = [pd.DataFrame({"lang": [], "gram": [], "n": []}).astype({"lang": "object", "gram": "int64", "n": "int64"})]
    for lang, found in words.items():
        word, hashes = gram_hashes(list(found), SIZES)
        unique, at = np.unique(hashes, return_inverse=True)
        times = np.bincount(at, np.fromiter(found.values(), np.float64, len(found))[word], len(unique))
        parts.append(pd.DataFrame({"lang": lang, "gram": unique.view(np.int64), "n": times.astype(np.int64)}))
    return pd.concat(parts, ignore_index=True)


def build_filters(typical: dict[str, list[int]], weight: dict[str, int]) -> Model:
    """Filters over each language's typical n-grams; ``weight`` decides between languages that score alike."""
    languages = sorted(typical)
    size = max(1024, ROWS_PER_GRAM * max((len(x) for x in typical.values()), default=1))
    rows = np.zeros((size, max(1, -(-len(languages) // 64))), np.uint64)
    prior = max(range(len(languages)), key=lambda i: (weight[languages[i]], -i)) if languages else 0
    model = Model(languages, rows, np.zeros(len(languages)), prior)
    for i, lang in enumerate(languages):
        at = model.places(np.array(typical[lang], np.int64).view(np.uint64)).astype(np.int64).reshape(-1)
        np.bitwise_or.at(rows[:, i // 64], at, np.uint64(1) << np.uint64(i % 64))
        full = (rows[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
        model.false_positive[i] = float(full.mean()) ** HASHES
    return model


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Filters learned from ``text`` and the non-null ``lang`` of the documents that are not held out.

    Counting runs on Spark; at most 1 / MIN_SHARE n-grams per language reach the driver.
    """
    learned = pick(docs, "doc_id", "text", "lang").filter(~held_out(F.col("doc_id")))
    counts = written(count_grams(learned, per_language), "gram-counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    share = counts.join(totals, "lang").select("lang", "gram", "total", (F.col("n") / F.col("total")).alias("share"))
    most = share.groupBy("gram").agg(F.max("share").alias("most"))
    typical = share.filter(F.col("share") >= MIN_SHARE).join(most, "gram")
    rows = typical.filter(F.col("share") >= PART_OF_MOST * F.col("most")).select("lang", "gram", "total").toPandas()
    found: dict[str, list[int]] = {}
    weight: dict[str, int] = {}
    for lang, gram, total in rows.itertuples(index=False):
        found.setdefault(lang, []).append(gram)
        weight[lang] = int(total)
    return build_filters(found, weight)


def predict_texts(model: Model, texts, words: WordTable) -> list[tuple[str, float]]:
    met = [words.numbers(_WORD.findall((t or "").lower())) for t in texts]
    words.fill(model.counts)
    out = []
    for text, at in zip(texts, met, strict=True):
        # digits of other scripts, fractions and enclosed numbers stand in words too, but only letters tell a language
        if not model.languages or not has_letter(text):
            out.append((UNKNOWN, 0.0))
            continue
        if not len(at):
            # a letter may still stand in a word that the pattern does not know
            out.append((model.languages[model.prior], 0.0))
            continue
        sums = words.table[at].sum(axis=0)
        real = np.maximum((sums[1:] - sums[0] * model.false_positive) / np.maximum(1 - model.false_positive, 1e-9), 0)
        best = int(real.argmax()) if real.max() > 0 else model.prior
        out.append((model.languages[best], float(min(1.0, real[best] / sums[0]))))
    words.trim()
    return out


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def predictor(model: Model):
    """A column function: language and score of a text, ``und`` for null and for texts without a letter."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words = WordTable(len(model.languages) + 1, _CACHED_WORDS)
        for texts in batches:
            held, out = list(texts), []
            for at in range(0, len(held), _ROWS):
                out += predict_texts(model, held[at : at + _ROWS], words)
            yield pd.DataFrame(out, columns=["lang_pred", "score"])

    return predict


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row, from its whole text alone.

    ``score`` is the corrected share of the n-grams that the language's filter contains. Null texts and texts
    without a letter are ``und``; with no labelled row to learn from, all are. Texts whose n-grams no filter
    contains get the language with the most training text and a score of 0. Equal scores go to the first language
    by name. Repeated rows each appear, and an empty table gives no rows. A text may be of any length: its words are
    held at once, and their n-grams are counted once per distinct word. More than ``MAX_LANGUAGES`` labels are an error.
    """
    model = model or train(docs)
    scored = pick(docs, "doc_id", "text").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), predictor(model)("text").alias("p")
    )
    return scored.select("doc_id", "held_out", "p.lang_pred", "p.score")

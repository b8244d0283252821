"""Toxicity scores from subword-bag embeddings averaged into a linear softmax.

A word is the average of the vectors of its character n-grams (and of the whole word between marks), a document the
average of its words, and a softmax over two classes sits on top. Vectors and weights are trained jointly in numpy
with Adam. Misspelt or inflected words never seen in training share n-gram vectors with those that were.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import held_out, pick
from emporia.llm.subwords import WordTable, gram_hashes
from emporia.sources.shared import written

SIZES = (3, 4, 5, 6)
BUCKETS = 1 << 17
DIMENSIONS = 8
#: Labelled documents of the toxic class and of the other that are trained on, in expectation.
SAMPLE_TOXIC, SAMPLE_OTHER = 1500, 4500
#: Size of the training texts of a class, in characters; longer texts are drawn at a lower rate.
SAMPLE_CHARS = 16_000_000
#: N-grams get a vector when the log-odds of finding them in a document of either class differ by this much, and by
#: this many standard errors; all others would only let single documents be learned by heart.
LEAST_ODDS, LEAST_ERRORS = 1.0, 2.5
EPOCHS, BATCH, RATE, DECAY = 12, 64, 0.02, 1e-5
THRESHOLD = 0.3
#: The document vector is scaled by this, so that a few words in a hundred can decide.
SCALE = 50.0
_CACHED_WORDS, _ROWS = 400_000, 1000
#: Bits of the hash that decides which texts fit, and how many of them are looked at in one pass.
_PLACE_BITS, _STEP_BITS = 60, 10
_WORD = re.compile(r"[^\W_]+")


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The number of the word and the bucket of each of its n-grams between marks."""
    word, hashes = gram_hashes(words, SIZES)
    return word, (hashes % np.uint64(BUCKETS)).astype(np.int64)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


@dataclass
class Model:
    """``vectors`` and the two-class softmax reduce to one number per bucket, the log-odds that it brings."""

    vectors: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def odds(self) -> np.ndarray:
        return (self.vectors @ (self.weights[:, 1] - self.weights[:, 0])) * SCALE

    def offset(self) -> float:
        return float(self.bias[1] - self.bias[0])


class _Corpus:
    """The words of training texts by number, and the buckets of every word one after the other."""

    def __init__(self, texts: list[str]) -> None:
        table = WordTable(1, 1 << 62)
        self.met = [np.unique(table.numbers(words_of(t)).astype(np.int32), return_counts=True) for t in texts]
        words, buckets, sizes = list(table), [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for at in range(0, len(words), 20_000):
            part = words[at : at + 20_000]
            word, bucket = subwords(part)
            buckets.append(bucket[np.argsort(word, kind="stable")].astype(np.int32))
            sizes.append(np.bincount(word, minlength=len(part)))
        self.buckets, self.sizes = np.concatenate(buckets), np.concatenate(sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def subwords_of(self, doc: int) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of a document's words and the share of each in its average."""
        at, times = self.met[doc]
        n = self.sizes[at]
        place = np.arange(n.sum()) + np.repeat(self.starts[at] - (np.cumsum(n) - n), n)
        return self.buckets[place], np.repeat(times / max(times.sum(), 1) / np.maximum(n, 1), n)

    def telling(self, labels: np.ndarray) -> np.ndarray:
        """Buckets whose document frequencies differ between the classes beyond chance."""
        found = np.full((2, BUCKETS), 0.5)
        for doc, label in enumerate(labels):
            held = np.zeros(BUCKETS, bool)
            held[self.subwords_of(doc)[0]] = True
            found[label] += held
        total = np.bincount(labels, minlength=2)[:, None] + 1.0
        odds = np.log(found / (total - found))
        error = np.sqrt((1 / found + 1 / (total - found)).sum(axis=0))
        apart = np.abs(odds[1] - odds[0])
        return (apart >= LEAST_ODDS) & (apart >= LEAST_ERRORS * error)

    def bags(self, telling: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each document its telling buckets, numbered among these, and their shares."""
        number = np.cumsum(telling) - 1
        out = []
        for doc in range(len(self.met)):
            bucket, share = self.subwords_of(doc)
            kept = telling[bucket]
            unique, where = np.unique(bucket[kept], return_inverse=True)
            out.append((number[unique], np.bincount(where, share[kept], len(unique)).astype(np.float32)))
        return out


def fit(texts: list[str], labels: np.ndarray, seed: int = 7) -> Model:
    """Joint training of vectors and softmax; without documents of both classes nothing is learned."""
    rng = np.random.default_rng(seed)
    vectors = np.zeros((BUCKETS, DIMENSIONS), np.float32)
    weights = rng.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    if len(set(labels.tolist())) < 2:
        return Model(vectors, weights, bias)
    corpus = _Corpus(texts)
    telling = corpus.telling(labels)
    bags = corpus.bags(telling)
    kept = rng.normal(0, 0.01, (int(telling.sum()), DIMENSIONS)).astype(np.float32)
    params = [kept, weights, bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    steps = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            grams = np.concatenate([bags[i][0] for i in chosen])
            parts = np.concatenate([bags[i][1] for i in chosen]) * SCALE
            rows = np.repeat(np.arange(len(chosen)), [len(bags[i][0]) for i in chosen])
            held = kept[grams] * parts[:, None]
            mean = np.stack([np.bincount(rows, held[:, d], len(chosen)) for d in range(DIMENSIONS)], axis=1)
            logits = mean @ weights + bias
            chance = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = chance / chance.sum(axis=1, keepdims=True)
            error[np.arange(len(chosen)), labels[chosen]] -= 1
            error /= len(chosen)
            flow = (error @ weights.T)[rows] * parts[:, None]
            gradient = np.stack([np.bincount(grams, flow[:, d], len(kept)) for d in range(DIMENSIONS)], axis=1)
            steps += 1
            for p, g, (m, v) in zip(params, (gradient + DECAY * kept, mean.T @ error, error.sum(0)), moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.99**steps)) + 1e-8)
    vectors[telling] = kept
    return Model(vectors, weights, bias)


def _fitting(texts: DataFrame, chars: int) -> DataFrame:
    """The rows of ``toxic, place, size`` below the largest place of each class up to which sizes add to ``chars``.

    Sizes are summed on Spark by the leading bits of the place, and again by more bits inside the part that overflows,
    so the driver sees at most 1,024 sums of a class at a time. No single size is above ``chars``.
    """
    ends: dict[int, int] = {}
    open_at = {0: (0, chars), 1: (0, chars)}
    for shift in range(_PLACE_BITS - _STEP_BITS, -1, -_STEP_BITS):
        inside = F.lit(False)
        for label, (start, _) in open_at.items():
            upto = start + (1 << (shift + _STEP_BITS))
            inside = inside | ((F.col("toxic") == label) & (F.col("place") >= start) & (F.col("place") < upto))
        part = F.shiftright("place", shift).alias("part")
        sums = texts.filter(inside).groupBy("toxic", part).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
        found = sorted((r["toxic"], r["part"], r["size"], r["n"]) for r in sums.collect())
        again = {}
        for label, (_, room) in open_at.items():
            for _, at, size, n in (x for x in found if x[0] == label):
                if size > room:
                    ends[label] = at << shift
                    if n > 1:
                        again[label] = (at << shift, room)
                    break
                room -= size
        open_at = again
        if not open_at:
            break
    for label, end in ends.items():
        texts = texts.filter((F.col("toxic") != label) | (F.col("place") < end))
    return texts


def train(
    docs: DataFrame,
    labels: DataFrame,
    toxic: int = SAMPLE_TOXIC,
    other: int = SAMPLE_OTHER,
    chars: int = SAMPLE_CHARS,
) -> Model:
    """A model from labelled documents that are not held out, a bounded number of each class in expectation.

    The draw is by a hash of the id, so it does not depend on the order or layout of the tables. Where the texts drawn
    of a class have more than ``chars`` characters, its rate is lowered, by a hash of id and text, until they fit. A
    single text above ``chars`` is left out and counts for nothing. Rows with the same id and text teach once; ids with
    two different labels, or with none, teach nothing.
    """
    marks = pick(labels, "doc_id", "toxic").filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    marks = marks.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other"))
    marks = marks.filter(F.col("toxic") == F.col("other")).filter(~held_out(F.col("doc_id"))).select("doc_id", "toxic")
    sizes = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    part = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1_000_000)) / 1_000_000
    keep = F.lit(False)
    for label, most in ((1, toxic), (0, other)):
        keep = keep | ((F.col("toxic") == label) & (part < most / max(sizes.get(label, 0), 1)))
    drawn = marks.filter(keep)
    # the draw is bounded by its parameters, so the texts of all other documents need not be shuffled
    texts = pick(docs, "doc_id", "text").join(F.broadcast(drawn), "doc_id")
    texts = texts.select("doc_id", "toxic", F.coalesce("text", F.lit("")).alias("text"), F.length("text").alias("size"))
    texts = texts.filter(F.coalesce("size", F.lit(0)) <= chars).dropDuplicates(["doc_id", "text"])
    place = F.shiftrightunsigned(F.xxhash64(F.lit("room"), "doc_id", "text"), 64 - _PLACE_BITS)
    sized = written(texts.withColumn("size", F.length("text").cast("long")).withColumn("place", place), "training-texts")
    rows = _fitting(sized, chars).select("doc_id", "text", "toxic").orderBy("doc_id", "text")
    chosen = [(row["text"], row["toxic"]) for row in rows.toLocalIterator()]
    return fit([t for t, _ in chosen], np.array([y for _, y in chosen], np.int64))


def score_texts(odds: np.ndarray, offset: float, texts, words: WordTable) -> np.ndarray:
    def rows_of(fresh: list[str]) -> np.ndarray:
        word, bucket = subwords(fresh)
        sums = np.bincount(word, odds[bucket], len(fresh))
        return (sums / np.maximum(np.bincount(word, minlength=len(fresh)), 1))[:, None]

    met = [words.numbers(words_of(t)) for t in texts]
    words.fill(rows_of)
    brought = np.array([words.table[at, 0].mean() if len(at) else 0.0 for at in met])
    words.trim()
    return 1 / (1 + np.exp(-np.clip(brought + offset, -500, 500)))


def scorer(model: Model):
    """A column function: chance of the toxic class for a whole text."""
    odds, offset = model.odds(), model.offset()

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = WordTable(1, _CACHED_WORDS)
        for texts in batches:
            held = list(texts)
            parts = [score_texts(odds, offset, held[at : at + _ROWS], words) for at in range(0, len(held), _ROWS)]
            yield pd.Series(np.concatenate([np.zeros(0), *parts]))

    return score


def toxicity(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row, from its whole text alone.

    Null and empty texts get the score of the softmax's bias. Without rows of both classes to learn from, every
    score is 0.5. Repeated rows each appear, and an empty table gives no rows.
    """
    model = model or train(docs, labels)
    scored = pick(docs, "doc_id", "text").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), scorer(model)("text").alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))

from __future__ import annotations

import random
import time

import brute
import numpy as np
import pyarrow as pa
import pytest
from cases import SCHEMA, documents, plain, with_clashes
from pyspark.sql import functions as F

from emporia.llm import hard_negatives, lm_score, maxent, spelling, token_hash

FOLDER = "/root/testdata/sf0.001"
SPELLED = ["word", "form", "root", "n", "n_near", "form_n"]
VECTORS = "vec_id long, label int, embedding array<float>"


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, FOLDER, limit=200).cache()


@pytest.fixture(scope="module")
def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def by_text(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x) for x in r))


def test_spelling_variants(docs, pairs):
    found = spelling.variants(with_clashes(docs)).select(*SPELLED).collect()
    assert by_text(found) == by_text(brute.spelling(pairs))


@pytest.mark.parametrize("long", [64, 9])
def test_chains_of_forms_and_long_words(spark, monkeypatch, long):
    monkeypatch.setattr(spelling, "LONG", long)
    rng = random.Random(5)
    base = ["abcdefgh", "aabbaabb", "aaaaaaaaa", "zzzzzzzé", "wordwordword"]
    words = []
    for word in base:
        words += [word] * 450
        for step, times in ((1, 45), (2, 4), (3, 2)):
            for _ in range(6):
                made = word
                for _ in range(step):
                    i, kind = rng.randrange(len(made)), rng.randrange(3)
                    letter = rng.choice("abwoé")
                    made = made[:i] + letter + made[i + (kind > 0) :] if kind < 2 else made[:i] + made[i + 1 :]
                words += [made] * times
    rng.shuffle(words)
    rows = [(i // 9, " ".join(words[i : i + 9])) for i in range(0, len(words), 9)]
    expected = brute.spelling(rows)
    assert any(r[1] != r[2] and r[1] for r in expected)  # some chain has more than one step
    found = spelling.variants(spark.createDataFrame(rows, "doc_id long, text string")).select(*SPELLED).collect()
    assert by_text(found) == by_text(expected)


def test_very_long_words_stay_linear(spark):
    word = "abcdefghij" * 20_000
    rows = [(i, w) for i, w in enumerate([word, word, word + "x", word + "x", word[:-1] + "y", word[:-1] + "y"])]
    began = time.time()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = spelling.variants(docs, every=2**32).select("word", "n", "n_near").collect()
    assert {r.word[-2:]: r.n_near for r in found} == {"ij": 2, "jx": 1, "iy": 1}
    assert time.time() - began < 60


def test_spelling_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert spelling.variants(empty).collect() == []
    assert spelling.variants(spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")).collect() == []
    with pytest.raises(ValueError, match="twice"):
        spelling.variants(empty, times=1)


def odd_vectors():
    rng = random.Random(4)
    rows = [(i, rng.randrange(4), [rng.gauss(0, 0.2) for _ in range(12)]) for i in range(300)]
    rows += [(i, rng.randrange(3), [rng.choice([0.0, 0.25, -0.25]) for _ in range(6)]) for i in range(300, 500)]  # ties
    rows += [(500, 1, [0.1] * 12), (500, 1, [0.1] * 12), (500, 2, [0.1] * 12), (-100, 1, [0.1] * 12), (None, 1, [0.1] * 12)]
    rows += [(None, 2, [0.05] * 12), (600, None, [0.1] * 12), (700, 1, None), (800, 1, []), (801, 1, []), (802, 2, [])]
    rows += [(900, 1, [0.1, None] + [0.1] * 10), (1000, 1, [float("nan")] + [0.1] * 11), (1100, 2, [float("inf")] * 12)]
    rows += [(1200, 3, [-0.1] * 12), (1300, 9, [0.3] * 12)]
    return [(i, label, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, label, v in rows]


@pytest.mark.parametrize("segment_rows", [40, 65_536])
def test_hard_negatives(spark, segment_rows):
    rows = odd_vectors()
    table = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS row", "2 AS LABEL", "'x' AS segment")
    found = hard_negatives.mine(table, F.col("vec_id") % 20 == 0, segment_rows=segment_rows).collect()
    assert plain(found) == plain(brute.negatives(rows, lambda i: i % 20 == 0))


def test_scan_keeps_what_may_win_and_reads_less():
    rng = np.random.default_rng(2)
    vectors = (rng.normal(size=(3000, 32)) * 0.7 ** np.arange(32) * 5000).astype(np.int64)
    columns = hard_negatives.Columns(np.arange(3000), np.arange(3000), np.zeros(3000), vectors)
    left = []

    def useful(low, high):
        keep = hard_negatives._first(5)(low, high)
        left.append(int(keep.sum()))
        return keep

    at, scores = columns.scan(vectors[7], np.arange(3000), useful)
    exact = vectors @ vectors[7]
    assert set(np.argsort(-exact)[:5]) <= set(at) and (exact[at] == scores).all()
    assert left[0] < 3000 and left[-1] == 5 and left == sorted(left, reverse=True)
    windows = [(int(0.8 * exact[8]), int(exact[8])), (-500, 500)]
    at, scores = columns.scan(vectors[7], np.arange(3000), hard_negatives._in_windows(windows, 5))
    for least, most in windows:
        wanted = np.sort(exact[(exact >= least) & (exact <= most)])[::-1][:5]
        assert (np.sort(scores[(scores >= least) & (scores <= most)])[::-1][:5] == wanted).all()


def test_large_components(spark):
    rows = [(0, 1, [3e6, 2e6]), (1, 1, [2.875e6, 2e6]), (2, 2, [2.75e6, 2e6]), (3, 2, [1.0, 1.0])]
    found = hard_negatives.mine(spark.createDataFrame(rows, VECTORS), F.col("vec_id") == 0).collect()
    assert plain(found) == plain(brute.negatives(rows, lambda i: i == 0))
    rows.append((4, 2, [3e30, 1.0]))
    with pytest.raises(Exception, match="64 bits"):
        hard_negatives.mine(spark.createDataFrame(rows, VECTORS), F.col("vec_id") == 0).collect()


def test_no_vectors(spark):
    assert hard_negatives.mine(spark.createDataFrame([], VECTORS), F.col("vec_id") % 20 == 0).collect() == []


@pytest.mark.parametrize("block", [1 << 16, 16, 5])
def test_token_hashes(monkeypatch, block):
    monkeypatch.setattr(token_hash, "BLOCK", block)
    monkeypatch.setattr(token_hash._Tables, "held", [])
    rng = random.Random(1)
    texts = [None, "", " a", "a", "b a\x0b\tA", "x" * 200, "x" * 199, "é É"]
    texts += ["".join(rng.choice("aB \n") for _ in range(rng.randint(0, 9))) for _ in range(300)]
    made, seen = token_hash.tokens(pa.array(["left", *texts]).slice(1)), {}
    for i, text in enumerate(texts):
        words = (text or "").encode().lower().split()
        begin, end = made.bounds[i], made.bounds[i + 1]
        assert end - begin == len(words) + 1 and made.h1[end - 1] == token_hash.END[0]
        for k, word in enumerate(words, begin):
            assert seen.setdefault(word, (made.h1[k], made.h2[k])) == (made.h1[k], made.h2[k])
            assert made.ending[k] == word[-1] * 256 + (word[-2] if len(word) > 1 else 0)
    assert len(set(seen.values())) == len(seen)
    assert (token_hash.tokens(pa.array(texts), hashes=1).h1 == made.h1).all()


def test_numbers_of_tokens():
    ids = np.array([0, 1, 65_535, 65_536, 3_000_000, 2**31])
    assert (lm_score.unpack(lm_score.pack(ids)) == ids).all()
    h1 = np.array([5, 5, 7, 5], np.uint64)
    for h2 in ([1, 1, 1, 1], [1, 2, 1, 1]):
        codes, first = lm_score._number(h1, np.array(h2, np.uint32))
        told = list(zip(h1.tolist(), h2, strict=True))
        assert [told[first[c]] for c in codes] == told and len(first) == len(set(told))


def test_base_scores_and_held_out_gain(docs, pairs):
    found = lm_score.lm_scores(with_clashes(docs)).collect()
    got = [(*r[:5], round(r.base_score, 6)) for r in found]
    assert plain(got) == plain(brute.base_scores(pairs))
    held = [r for r in found if r.held_out]
    assert all(np.isfinite(r.score) and r.score < 0 for r in found)
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def _small_model():
    """A model trained on random texts, its tokens, their distinct hashes with endings and counts, and the head's places."""
    rng = np.random.default_rng(0)
    texts = pa.array([" ".join(f"w{x}" for x in rng.zipf(1.3, 200) % 3000) for _ in range(40)])
    tokens = token_hash.tokens(texts)
    hashes, at, counts = np.unique(tokens.h1, return_index=True, return_counts=True)
    endings = tokens.ending[at].astype(np.int64)
    top = np.argsort(-counts, kind="stable")[: maxent.HEAD_CLASSES * maxent.SLOTS]
    head = maxent.Head.of(hashes[top], endings[top])
    assert (head.find(hashes[top]) >= 0).all() and len(set(head.numbers)) == len(top)
    rest = np.setdiff1d(np.arange(len(hashes)), top)
    kinds = maxent.open_class(endings[rest]) - maxent.HEAD_CLASSES
    totals = 1.0 + np.bincount(kinds, counts[rest] + 1, maxent.OPEN_CLASSES)
    order = np.argsort(hashes[top])
    model = maxent.Model.start(head, counts[top][order].astype(float), totals)
    before = maxent.log10_parts(model, tokens).sum()
    touched = [np.zeros(len(t), np.int64) for t in model.tables]
    for _ in range(3):
        maxent.learn(model, tokens, touched)
    assert maxent.log10_parts(model, tokens).sum() > before
    return model, tokens, hashes, endings, counts, rest, kinds, totals


def test_model_is_a_distribution():
    model, tokens, hashes, endings, counts, rest, kinds, totals = _small_model()
    # after one context, the probabilities of all words of the vocabulary and of a new word of each class add up to 1
    every = [token_hash.Tokens(np.append(tokens.h1[:2], h), np.append(tokens.h2[:2], h), np.append(tokens.ending[:2], e), np.array([0, 3])) for h, e in zip(hashes, endings, strict=True)]
    inside = np.array([10 ** maxent.log10_parts(model, x)[2] for x in every])
    share = np.ones(len(hashes))
    share[rest] = (counts[rest] + 1) / totals[kinds]
    new = sum(inside[rest[np.argmax(kinds == k)]] / totals[k] for k in range(maxent.OPEN_CLASSES) if (kinds == k).any())
    unseen_classes = maxent.OPEN_CLASSES - len(set(kinds.tolist()))
    assert inside @ share + new == pytest.approx(1.0, abs=1e-3 + 0.01 * unseen_classes)


def test_model_by_plain_sums():
    """Features, rows and both softmaxes of single tokens with plain whole numbers and floats."""
    model, tokens, *_ = _small_model()
    mask, salts = 2**64 - 1, [int(x) for x in maxent._SALTS]
    shift = 64 - maxent.ROW_BITS

    def softmax(bias, table, rows, at):
        logits = [float(b) + sum(float(table[r][j]) for r in rows) for j, b in enumerate(bias)]
        top = max(logits)
        return np.exp(logits[at] - top) / sum(np.exp(x - top) for x in logits)

    found = maxent.log10_parts(model, tokens)
    numbers = dict(zip(model.head.hashes.tolist(), model.head.numbers.tolist(), strict=True))
    for doc in (0, 7):
        begin, end = int(tokens.bounds[doc]), int(tokens.bounds[doc + 1])
        for at in [begin, begin + 1, begin + 2, begin + 3, (begin + end) // 2, end - 1]:
            back = [int(tokens.h1[at - k]) if at - k >= begin else int(maxent._START) for k in (1, 2, 3)]
            joint = (back[0] * salts[1] + (back[1] ^ back[1] >> 29) * salts[2]) & mask
            features = [x * s & mask for x, s in zip((back[0], joint, back[1], back[2]), salts, strict=True)]
            number = numbers.get(int(tokens.h1[at]), -1)
            kind = number // maxent.SLOTS if number >= 0 else int(maxent.open_class(tokens.ending[at : at + 1])[0])
            chance = softmax(model.class_bias, model.tables[0], [f >> shift for f in features], kind)
            if number >= 0:
                rows = [((f ^ f >> 31) * (kind * salts[3] + salts[2] | 1) & mask) >> shift for f in features]
                chance *= softmax(model.slot_bias[kind], model.tables[1], rows, number % maxent.SLOTS)
            assert found[at] == pytest.approx(np.log10(chance), abs=1e-4)


def test_scores_of_odd_tables(spark):
    assert lm_score.lm_scores(spark.createDataFrame([], SCHEMA)).collect() == []
    (row,) = lm_score.lm_scores(spark.createDataFrame([(None, None)], "doc_id long, text string")).collect()
    assert tuple(row)[:6] == (None, True, 1, 0, 0, 0.0) and np.isfinite(row.score)
    rows = [(1, "a b " * 300_000), (2, "x" * 1_000_000), (3, "c")]
    got = lm_score.lm_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert plain([(*r[:5], round(r.base_score, 4)) for r in got]) == plain([(*r[:5], round(r[5], 4)) for r in brute.base_scores(rows)])

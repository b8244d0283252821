from __future__ import annotations

import hashlib
import os
import random
import re

import brute
import corpus_pipeline
from cases import SCHEMA, documents, with_clashes
from pyspark.sql import functions as F

from emporia.llm import langid, mixing, queries
from emporia.sources.shared import shared_folder

FOLDER = "/root/testdata/sf0.001"


def _stages(spark, docs):
    out = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER).cache()
        out.append(docs)
    return out


def _rows(df):
    return sorted((r.doc_id is not None, r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_every_stage_on_what_the_one_before_kept(spark):
    docs = documents(spark, FOLDER, 150).cache()
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    named, lines, near, clean, mixed = _stages(spark, docs)
    for stage in (named, lines, near, clean):
        assert stage.columns == docs.columns
        assert all(r.n_chars == len(r.text) for r in stage.collect() if stage is not named and r.n_chars is not None)

    # language: the documents of the table are all in a language that they teach; texts without a letter go, and one of
    # the awkward rows, which mixes scripts
    kept = [(r.doc_id, r.text) for r in docs.collect() if r.text and any(map(str.isalpha, r.text)) and r.doc_id != 900009]
    assert _rows(named) == sorted((i is not None, i, t) for i, t in kept)

    # lines: counts and digests of what is left
    want = sorted(str(x) for x in brute.lines(kept))
    after = [(r.doc_id, r.text) for r in lines.collect()]
    digests = {hashlib.sha256(t.encode()).hexdigest() for _, t in after}
    assert {x[3] for x in brute.lines(kept)} == digests and len(after) == len(want)

    # near duplicates: one row of each component, the one with its smallest id
    groups = {}
    for i, _, root in brute.simhash(after):
        groups.setdefault(root, []).append(i)
    left = [(r.doc_id, r.text) for r in near.collect()]
    assert sorted(i for i, _ in left if i is not None) == sorted(g for g in groups if g is not None)
    assert set(left) <= set(after)

    # benchmark: no window is left, clean documents are untouched
    cut = [(r.doc_id, r.text) for r in clean.collect()]
    assert not any(x[-1] for x in brute.decontaminate(cut, items))
    hit = {x[0] for x in brute.decontaminate(left, items) if x[-1]}
    assert {x for x in left if x[0] not in hit} <= set(cut) and len(cut) == len(left)

    # mix: every source near its target, words taken of documents that the mix leaves out are none
    rows = mixed.collect()
    sizes = {}
    for r in clean.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    aims, taken = brute.targets(sizes), dict.fromkeys(sizes, 0)
    for r in rows:
        assert 0 < r.taken <= 3 * r["size"] and (r.doc_id, r.text) in cut
        taken[r.source] += r.taken
    longest = max(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in clean.collect())
    assert all(abs(taken[s] - aims[s]) <= longest for s in sizes) and sum(taken.values()) == sum(sizes.values())


def test_stages_with_clashing_columns_and_empty_tables(spark):
    docs = with_clashes(documents(spark, FOLDER, 20))
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, FOLDER)
        assert made.columns == docs.columns and made.count() > 0
        assert stage(spark, empty, FOLDER).count() == 0
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs, FOLDER).count() > 0 and last(spark, empty, FOLDER).count() == 0


def test_repeats_of_one_row_meet_before_they_are_shuffled(spark):
    rows = spark.range(0, 4000, 1, 4).selectExpr("cast(null as long) AS doc_id", "'one text of some words' AS text", "'s' AS source")
    near = corpus_pipeline.simhash_near_dedup(spark, rows, FOLDER)
    assert [tuple(r) for r in near.collect()] == [(None, "one text of some words", "s")]
    plan = near._jdf.queryExecution().analyzed().toString()
    assert "windowspecdefinition(_key" not in plan and "Deduplicate [_key" in plan.split("LeftSemi")[1]


def _spoken(spark, folder="/root/testdata/sf0.01"):
    return spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")


def test_language_stage_decides_by_the_model(spark, monkeypatch):
    rng = random.Random(2)
    known = _spoken(spark)
    strange = ["Это совсем другой язык и другая письменность", "αυτό είναι μια άλλη γλώσσα", "数字和文字在这里"]
    strange += ["".join(rng.choice("qxzjkvwp") for _ in range(60)) for _ in range(5)]
    rows = [(10_000 + i, t, None, "s", len(t)) for i, t in enumerate(strange)]
    docs = known.union(spark.createDataFrame(rows, SCHEMA)).cache()
    kept = corpus_pipeline.language_id(spark, docs, FOLDER)
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert ids == {r.doc_id for r in known.collect() if any(map(str.isalpha, r.text or ""))}  # clean documents stay
    only = corpus_pipeline.language_id(spark, docs, FOLDER, languages=("de",))
    told = [r.lang for r in only.collect()]
    assert len(told) > 100 and sum(x == "de" for x in told) >= 0.98 * len(told)
    # without what the model says all of them would stay
    monkeypatch.setattr(corpus_pipeline.langid, "train", lambda docs: langid.build_filters({}, {}))
    assert corpus_pipeline.language_id(spark, docs, FOLDER).count() == len(ids) + len(strange)


def test_language_stage_fills_missing_languages(spark):
    docs = _spoken(spark)
    some = docs.withColumn("lang", F.when(F.col("doc_id") % 3 > 0, F.col("lang")))
    true = {r.doc_id: r.lang for r in docs.collect()}
    made = corpus_pipeline.language_id(spark, some, FOLDER).collect()
    assert sum(r.lang == true[r.doc_id] for r in made) >= 0.98 * len(made) and all(r.lang for r in made)


def test_language_stage_with_nothing_to_learn(spark):
    rows = [(1, "some words", None, "s", 10), (2, "12 34", None, "s", 5), (3, None, None, "s", None), (4, "数字", None, None, 2)]
    kept = corpus_pipeline.language_id(spark, spark.createDataFrame(rows, SCHEMA), FOLDER)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4]


def test_repeated_rows_in_the_mix(spark, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "_REPEATS", 7)
    rows = [(1, "four words of text", "en", "a", 18)] * 50 + [(i, "w " * (i % 9 + 1), "en", "ab"[i % 2], 2) for i in range(2, 60)]
    rows += [(None, "x y", "en", None, 3)] * 20
    docs = spark.createDataFrame(rows, SCHEMA)
    mixed = corpus_pipeline.source_mixing(spark, docs, FOLDER).collect()
    plan = [r for r in mixing.mix(docs, (1, 2, 3), 3).collect() if r.taken]
    key = lambda r: (str(r.doc_id), str(r.source), r["size"], r.taken)
    assert sorted(map(key, mixed)) == sorted(map(key, plan))
    assert sum(r.taken for r in mixed) == sum(len(t.split()) for _, t, *_ in rows)


def test_nothing_is_left_but_the_result(spark):
    folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"
    left = lambda: set(os.listdir(folder)) if os.path.isdir(folder) else set()
    before = left()
    made = corpus_pipeline.run(spark, FOLDER)
    assert [x.rsplit("-", 1)[0] for x in left() - before] == ["source_mixing"] and made.count() > 0
    before = left()
    queries.queries()["op3_simhash"](spark, FOLDER)
    assert [x.rsplit("-", 1)[0] for x in left() - before] == ["op3_simhash"]

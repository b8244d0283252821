"""Spelling variants by a permuterm index.

A word marked with a terminator is rotated at every place. Two words that differ in one replaced letter have rotations
that agree in all but their last letter, the replaced one; a word with one letter more has a rotation that begins with
a whole rotation of the shorter word and ends with that letter. So all rotations are sorted, and every group of those
that share the prefix without the last letter is scanned: whole rotations equal to the prefix stand beside rotations
with one letter after it. A group has at most one whole rotation and one rotation for each letter. The scan does not
list pairs: each member gets the number of its neighbours in the group and the best of them, and sums over a word's
groups finish the work. Rows stay in proportion to the letters of the vocabulary.

Rotations of words longer than ``LONG`` letters are written as digests of the part before and the part after the
skipped place, which takes the same room for each rotation however long the word is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import lower_ascii, pick
from emporia.sources.shared import written

LETTERS = "A-Za-zÀ-ÿ"
MARK = "$"
#: Letters of a word whose rotations are written out.
LONG = 64
ROTATIONS = "prefix string, last string, id long, n long"
_BATCH = 10_000


def edited_words(docs: DataFrame, min_chars: int = 7, every: int = 31) -> DataFrame:
    """``word``, a row for each run of letters that has ``min_chars`` code points after its deletion, A-Z lower-cased.

    A run loses the letter at ``h`` modulo its length where ``every`` divides ``h``, the CRC-32 of the document's id, a
    colon and the run. A null id stands for no characters.
    """
    found = F.regexp_extract_all(F.col("text"), F.lit(f"[{LETTERS}]{{{min_chars},}}"), F.lit(0))
    runs = pick(docs, "doc_id", "text").select("doc_id", F.explode(found).alias("run"))
    runs = runs.select("doc_id", lower_ascii(F.col("run")).alias("run"))
    told = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    hashed = runs.withColumn("h", F.crc32(told.cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.expr("substring(run, cast(h % length(run) as int) + 2)"))
    words = hashed.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= min_chars)


def numbered(words: DataFrame, min_count: int = 2) -> DataFrame:
    """``id, word, n`` of the words that occur ``min_count`` times; ids ascend in code-point order of the words."""
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)
    counts = written(counts, "word-counts")  # written, since finding the ranges reads the rows once more
    dealt = counts.repartitionByRange("word").sortWithinPartitions("word")
    return written(dealt.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")


def _written_out(words: DataFrame) -> DataFrame:
    """Rotations of words of up to ``LONG`` letters: with the last letter apart, and whole."""
    short = words.filter(F.length("word") <= LONG).withColumn("twice", F.concat("word", F.lit(MARK), "word"))
    skipped = "transform(sequence(0, length(word) - 1), i -> struct(substring(twice, i + 2, length(word)) AS prefix, substring(word, i + 1, 1) AS last))"
    whole = "transform(sequence(0, length(word)), i -> struct(substring(twice, i + 1, length(word) + 1) AS prefix, '' AS last))"
    return short.select(F.expr(f"inline(concat({skipped}, {whole}))"), "id", "n")


def _digested(word: str) -> Iterator[tuple[str, str]]:
    """Prefix and last letter of each rotation of a long word; a prefix ends with its last letter, as if written out."""
    before, after = [hashlib.blake2b(digest_size=16)], [hashlib.blake2b(digest_size=16, key=b"after")]
    heads, tails = [before[0].hexdigest()], [after[0].hexdigest()]
    for left, right in zip(word, reversed(word), strict=True):
        before[0].update(left.encode())
        after[0].update(right.encode())
        heads.append(before[0].copy().hexdigest())
        tails.append(after[0].copy().hexdigest())
    for i in range(len(word) + 1):
        shown = MARK if i == 0 else word[i - 1]
        if i < len(word) and len(word) > LONG:
            yield f"#{heads[i]}{tails[len(word) - i - 1]}{shown}", word[i]
        yield f"#{heads[i]}{tails[len(word) - i]}{shown}", ""


def _long_rotations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["prefix", "last", "id", "n"]
    for batch in batches:
        for word in batch.to_pylist():
            rows = []
            for prefix, last in _digested(word["word"]):
                rows.append((prefix, last, word["id"], word["n"]))
                if len(rows) == _BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)


def rotations(words: DataFrame) -> DataFrame:
    """``prefix, last, id, n``: for each place of a word the rotation that skips it, and the whole rotation.

    ``last`` is empty for whole rotations. Words of ``LONG`` letters stand in both forms as whole rotations, so that they
    meet those with one letter more.
    """
    long = words.filter(F.length("word") >= LONG).select("id", "word", "n")
    return _written_out(words).union(long.mapInArrow(_long_rotations, ROTATIONS))


def neighbourhoods(words: DataFrame) -> DataFrame:
    """``id, n_near, best`` of the words that have near words; ``best`` has the largest count, then the smallest id."""
    sorted_ = rotations(words).repartitionByRange("prefix").withColumn("members", F.expr("count(*) OVER (PARTITION BY prefix)"))
    shared = sorted_.filter(F.col("members") > 1)
    place = F.struct((-F.col("n")).alias("rank"), F.col("id"))
    whole = F.col("last") == ""
    # a letter in a run of its kind may be skipped at several places to the same end: only the first of them counts
    first_of_run = F.col("last") != F.substring("prefix", -1, 1)
    groups = shared.groupBy("prefix").agg(
        F.sort_array(F.collect_list(F.when(~whole, F.struct(place.alias("place"), first_of_run.alias("longer"))))).alias("held"),
        F.max(F.when(whole, place)).alias("whole"),
    )
    longer = F.filter("held", lambda x: x["longer"])
    shorter = groups.filter(F.col("whole").isNotNull()).select(
        F.col("whole.id").alias("id"), F.size(longer).alias("near"), F.get(longer, F.lit(0))["place"].alias("best")
    )
    each = groups.select("held", "whole", F.explode("held").alias("own"))
    others = F.when(F.col("held")[0]["place"]["id"] == F.col("own.place.id"), F.get("held", F.lit(1))["place"]).otherwise(
        F.col("held")[0]["place"]
    )
    less = F.when(F.col("own.longer"), F.col("whole"))
    members = each.select(
        F.col("own.place.id").alias("id"),
        (F.size("held") - 1 + less.isNotNull().cast("int")).alias("near"),
        F.when(less.isNull(), others).otherwise(F.least(others, less)).alias("best"),
    )
    found = shorter.union(members).filter(F.col("near") > 0)
    return found.groupBy("id").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def _roots(forms: DataFrame, times: int, most: int) -> DataFrame:
    """``id, root`` from ``id, form_id``: the last of the forms. Each is ``times`` as frequent as the one before, so
    the chains are no longer than the largest count allows, and every round doubles the part that is followed."""
    steps, reach = 1, times
    while reach < most:
        steps, reach = steps + 1, reach * max(times, 2)
    roots = forms.select("id", F.col("form_id").alias("root"))
    for turn in range(max(steps - 1, 1).bit_length()):
        ahead = roots.select(F.col("id").alias("root"), F.col("root").alias("further"))
        roots = roots.join(ahead, "root", "left").select("id", F.coalesce("further", "root").alias("root"))
        roots = written(roots, f"roots-{turn}")
    return roots


def variants(
    docs: DataFrame, *, min_chars: int = 7, min_count: int = 2, every: int = 31, times: int = 10
) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for every word of the vocabulary.

    Words are runs of the letters ``LETTERS``, A-Z lower-cased, with the deletions of :func:`edited_words`, of at least
    ``min_chars`` code points and ``min_count`` occurrences (``n``) over all documents. Two words are near when one
    inserted, deleted or replaced code point tells them apart. A word's form is its near word with the largest count
    (ties: the smallest in code-point order) if that is at least ``times`` its own; the root follows forms to the last.

    Null and empty texts have no words, an empty table gives no rows, and rows that repeat count again. A null id
    counts as empty. A text may be of any length; so may a word, whose rotations take room in proportion to its length.
    """
    if times < 2:
        raise ValueError("a form must be at least twice as frequent, or forms could lead in a circle")
    words = numbered(edited_words(docs, min_chars, every), min_count)
    most = words.agg(F.max("n")).first()[0] or 0
    near = written(neighbourhoods(words), "neighbourhoods")
    best_n = -F.col("best.rank")
    forms = words.select("id", "n").join(near, "id").filter(best_n >= times * F.col("n"))
    forms = written(forms.select("id", F.col("best.id").alias("form_id"), best_n.alias("form_n")), "forms")
    named = words.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    last = words.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    rooted = _roots(forms, times, most).withColumnRenamed("root", "root_id")
    links = forms.join(rooted, "id").join(named, "form_id").join(last, "root_id").select("id", "form", "form_n", "root")
    return (
        words.join(near.select("id", "n_near"), "id", "left")
        .join(links, "id", "left")
        .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))
    )


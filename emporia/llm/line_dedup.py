"""Line deduplication by range-partitioned hashes, returned as a keep bitmap per document.

Each line becomes a row of two 64-bit hashes of its key, the document and the position. The rows are dealt out in
ranges of (hash, document, text, position) and sorted in that order, so a very common line spreads over as many tasks
as it needs. One pass streams over every task's rows and counts first occurrences in documents; of the run of equal
hashes at hand it keeps at most ``HELD_ROWS`` rows. A run that reaches the threshold passes its rows on. What one task
cannot decide are runs that touch its border and runs of more rows than are kept from too few documents: of them it
only tells the first documents, fewer than the threshold, or that the threshold was reached. The hashes that these
reports decide are few, two for each task and one for each ``HELD_ROWS`` rows, and a second pass reads their rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import lower_ascii, pick
from emporia.sources.shared import written

STRIPPED = " \t\n\x0b\x0c\r"
ROWS = "kind int, h1 long, h2 long, doc_id long, version long, position int"
DROP, DOCUMENT, COMMON = 0, 1, 2
#: Rows of one hash that a task keeps while it does not know whether the line is common.
HELD_ROWS = 50_000


def line_rows(docs: DataFrame, min_chars: int) -> DataFrame:
    """A row for each line whose key has at least ``min_chars`` code points."""
    lines = docs.select(
        "doc_id", "version", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("position", "line")
    )
    keyed = lines.select(
        "doc_id", "version", "position", lower_ascii(F.btrim("line", F.lit(STRIPPED))).alias("key")
    ).filter(F.length("key") >= min_chars)
    return keyed.select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2"), "doc_id", "version", "position"
    )


class _Runs:
    """The run of equal hashes at hand, of which batches of sorted rows may hold only a part."""

    def __init__(self, threshold: int) -> None:
        self.threshold = threshold
        self.key: tuple[int, int] | None = None
        self.first_run = True
        self.start()

    def start(self) -> None:
        self.docs, self.last, self.late = 0, None, False
        self.held: list[pd.DataFrame] = []
        self.held_rows = 0
        self.firsts: list[int | None] = []

    def close(self, last_run: bool) -> list[pd.DataFrame]:
        """End the run and report on it where this task alone cannot decide it."""
        out = []
        border = self.first_run or last_run
        if self.key is not None:
            told = {"h1": self.key[0], "h2": self.key[1]}
            if self.docs >= self.threshold and (border or self.late):
                out.append(pd.DataFrame({"kind": [COMMON], **{k: [v] for k, v in told.items()}}))
            elif self.docs < self.threshold and border:
                ids = pd.Series(self.firsts, dtype=object)
                out.append(pd.DataFrame({"kind": DOCUMENT, "doc_id": ids, **told}))
        self.key, self.first_run = None, False
        self.start()
        return out

    def add(self, rows: pd.DataFrame, firsts: list, new_docs: int, key: tuple[int, int]) -> list[pd.DataFrame]:
        """Rows that all carry ``key`` and continue the run in hand or start it; ``firsts`` are its new documents."""
        self.key = key
        self.docs += new_docs
        self.firsts += firsts[: self.threshold - len(self.firsts)]
        if self.late:
            return []
        self.held.append(rows)
        self.held_rows += len(rows)
        if self.docs >= self.threshold:
            ready, self.held, self.held_rows = [x.assign(kind=DROP) for x in self.held], [], 0
            return ready
        if self.held_rows > HELD_ROWS:
            self.late, self.held = True, []
        return []


def _stream(threshold: int):
    """Decisions of one task from its rows, sorted by hash, document and position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Runs(threshold)
        for batch in batches:
            if not batch.num_rows:
                continue
            out: list[pd.DataFrame] = []
            rows = batch.to_pandas(integer_object_nulls=True)
            h1, h2 = rows["h1"].to_numpy(np.int64), rows["h2"].to_numpy(np.int64)
            missing = rows["doc_id"].isna().to_numpy()
            ids = rows["doc_id"].where(~missing, 0).to_numpy(np.int64)
            starts = np.ones(len(rows), bool)
            starts[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            fresh = starts.copy()
            fresh[1:] |= (ids[1:] != ids[:-1]) | (missing[1:] != missing[:-1])
            begin = np.nonzero(starts)[0]
            end = np.append(begin[1:], len(rows))

            def firsts(a: int, b: int) -> list:
                at = a + np.nonzero(fresh[a:b])[0][:threshold]
                return [None if missing[i] else int(ids[i]) for i in at]

            docs = np.add.reduceat(fresh.astype(np.int64), begin)
            key, who = (int(h1[0]), int(h2[0])), (int(ids[0]), bool(missing[0]))
            if state.key is not None and state.key != key:
                out += state.close(last_run=False)
            if state.key == key and state.last == who:
                fresh[0] = False
                docs[0] -= 1
            out += state.add(rows.iloc[: end[0]], firsts(0, end[0]), int(docs[0]), key)
            if len(begin) > 1:
                out += state.close(last_run=False)
                common = np.zeros(len(rows), bool)
                for i in np.nonzero(docs[1:-1] >= threshold)[0] + 1:
                    common[begin[i] : end[i]] = True
                if common.any():
                    out.append(rows[common].assign(kind=DROP))
                at = begin[-1]
                out += state.add(rows.iloc[at:], firsts(at, len(rows)), int(docs[-1]), (int(h1[-1]), int(h2[-1])))
            state.last = (int(ids[-1]), bool(missing[-1]))
            if out:
                yield _batch(out)
        if out := state.close(last_run=True):
            yield _batch(out)

    return run


def _batch(frames: list[pd.DataFrame]) -> pa.RecordBatch:
    columns = {
        "kind": pa.int32(),
        "h1": pa.int64(),
        "h2": pa.int64(),
        "doc_id": pa.int64(),
        "version": pa.int64(),
        "position": pa.int32(),
    }
    made = {}
    for name, kind in columns.items():
        made[name] = pa.chunked_array(
            [
                pa.array(x[name].tolist() if x[name].dtype == object else x[name], kind, from_pandas=True)
                if name in x
                else pa.nulls(len(x), kind)
                for x in frames
            ],
            kind,
        ).combine_chunks()
    return pa.RecordBatch.from_arrays(list(made.values()), names=list(made))


def _bitmap(dropped: pd.Series) -> pd.Series:
    """Deflated bits, 1 for a line to keep; lines beyond the last bit are kept."""

    def one(positions) -> bytes:
        bits = np.ones(int(max(positions)) + 1, np.uint8)
        bits[np.asarray(positions, np.int64)] = 0
        return zlib.compress(np.packbits(bits).tobytes() + bytes([len(bits) % 8]))

    return dropped.map(one)


def read_bitmap(packed: bytes) -> np.ndarray:
    raw = zlib.decompress(packed)
    bits = np.unpackbits(np.frombuffer(raw, np.uint8, len(raw) - 1))
    return bits[: len(bits) - (-raw[-1] % 8)].astype(bool)


def versions(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and a hash of the text, which tells rows with the same id apart."""
    return pick(docs, "doc_id", "text").withColumn("version", F.xxhash64("text"))


def line_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """Keep bitmaps (``doc_id, version, keep_bits``) of the documents that lose a line.

    A line goes, in every document (with ``keep_first`` in all places but the first by id and position), when its key
    (stripped of white space at both ends, A-Z lower-cased, at least ``min_chars`` code points) is found in at least
    ``min_docs`` documents. A document is a ``doc_id``; rows with the same id, or with none, count once, and rows that
    repeat lose the same lines. ``version`` is the 64-bit hash of the text. Null text is one empty line. A text may
    have any number of lines: only its bitmap and the positions that it loses are ever held together.
    """
    # written, since finding the ranges reads the rows once more
    rows = written(line_rows(versions(docs), min_chars), "line-hashes")
    at = ["h1", "h2", "doc_id", "version", "position"]
    dealt = rows.repartitionByRange(*at).sortWithinPartitions(*at)
    decided = written(dealt.mapInArrow(_stream(min_docs), ROWS), "line-runs")
    kind = F.col("kind")
    holders = F.count_distinct(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))
    few = decided.filter(kind == DOCUMENT).groupBy("h1", "h2").agg(holders.alias("docs")).filter(F.col("docs") >= min_docs)
    late = few.select("h1", "h2").union(decided.filter(kind == COMMON).select("h1", "h2")).distinct()
    dropped = decided.filter(kind == DROP).select(*at).union(rows.join(late, ["h1", "h2"], "left_semi").select(*at))
    if keep_first:
        place = F.struct("doc_id", "version", "position")
        first = dropped.groupBy("h1", "h2").agg(F.min(place).alias("place"))
        dropped = dropped.withColumn("place", place).join(first, ["h1", "h2", "place"], "left_anti")
    return (
        dropped.groupBy("doc_id", "version")
        .agg(F.collect_set("position").alias("dropped"))
        .select("doc_id", "version", F.pandas_udf(_bitmap, "binary")("dropped").alias("keep_bits"))
    )


APPLIED = "n_lines long, n_dropped long, kept string"


def _apply(text: pd.Series, keep_bits: pd.Series) -> pd.DataFrame:
    """Number of lines, number dropped and the other lines joined; without a bitmap all lines stay."""
    out = []
    for body, packed in zip(text, keep_bits, strict=True):
        body = body or ""
        if packed is None:
            out.append((body.count("\n") + 1, 0, body))
            continue
        lines = body.split("\n")
        bits = read_bitmap(packed)
        kept = [x for i, x in enumerate(lines) if i >= len(bits) or bits[i]]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return pd.DataFrame(out, columns=["n_lines", "n_dropped", "kept"])


def apply_bitmap(text: str, keep_bits: str) -> Column:
    return F.pandas_udf(_apply, APPLIED)(text, keep_bits)


def with_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """Every row of ``doc_id, text`` with its bitmap, null where all lines stay."""
    bitmaps = line_bitmaps(docs, min_docs, min_chars, keep_first).toDF("b_id", "b_version", "keep_bits")
    same = F.col("doc_id").eqNullSafe(F.col("b_id")) & (F.col("version") == F.col("b_version"))
    return versions(docs).join(bitmaps, same, "left").select("doc_id", "version", "text", "keep_bits")


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_text, keep_bits`` for every row; an empty table gives no rows.

    Null and empty texts are one empty line, which counts as a line only with ``min_chars`` of 0. Rows without an id
    count as one document together, rows that repeat each get their result, and columns beside ``doc_id`` and ``text``
    may have any name. A very long text is held once, with its lines, while its bitmap is applied.
    """
    applied = with_bitmaps(docs, min_docs, min_chars, keep_first).withColumn("made", apply_bitmap("text", "keep_bits"))
    return applied.select("doc_id", "made.n_lines", "made.n_dropped", F.col("made.kept").alias("kept_text"), "keep_bits")

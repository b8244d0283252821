"""Hard-negative mining by a vertical branch-and-bound scan.

Rows are dealt out over segments of bounded size, and every anchor visits every segment. A segment is held by
dimension: one column for each, with its smallest and largest value. An anchor reads the columns in descending order
of its own magnitudes, a few at a time. After each look a row's score lies between its sum so far plus the smallest
and plus the largest contribution that the columns not yet read can make; rows whose interval can no longer enter a
result leave the candidates. What is left at the end has exact scores. The first scan finds an anchor's positives,
the second the rows in the score window below each of them; both only pass on what may be among the first few.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporia.llm.common import pick, shuffle_partitions
from emporia.sources.shared import written

#: Rows that a task holds by column at a time.
SEGMENT_ROWS = 65_536
#: Parts in which an anchor's columns are read; candidates are thinned out after each.
LOOKS = 4
_EXACT = 2**53
_HITS = pa.schema([("anchor", pa.int64()), ("window", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64()), ("score", pa.int64())])
HITS = "anchor long, window long, vec_id long, row long, score long"


class Columns:
    """The rows of a segment with vectors of one length, by dimension."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.rows, self.labels = ids, rows, labels
        self.values = np.ascontiguousarray(vectors.T)
        self.low = self.values.min(axis=1, initial=0) if not len(rows) else self.values.min(axis=1)
        self.high = self.values.max(axis=1, initial=0) if not len(rows) else self.values.max(axis=1)
        self.reach = int(np.abs(vectors).max(initial=0))
        self.floats = self.values.astype(np.float64) if self.reach < _EXACT else None

    def scan(self, anchor: np.ndarray, candidates: np.ndarray, useful) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``candidates`` that ``useful(low, high)`` keeps to the end, with their exact scores."""
        most = len(anchor) * self.reach * int(np.abs(anchor).max(initial=0))
        if most >= 2**63:
            raise ValueError("an inner product may not fit into 64 bits")
        exact = most < _EXACT and self.floats is not None  # every sum on the way is a whole number that a float holds
        values, query = (self.floats, anchor.astype(np.float64)) if exact else (self.values, anchor)
        ends = np.stack([anchor * self.low, anchor * self.high])
        order = np.argsort(-np.abs(anchor), kind="stable")
        least, most = ends.min(axis=0)[order], ends.max(axis=0)[order]
        sums = np.zeros(len(candidates), values.dtype)
        everything = len(candidates) == values.shape[1]
        step = max(1, -(-len(anchor) // LOOKS))
        for at in range(0, len(anchor), step):
            if not len(candidates):
                break
            dims = order[at : at + step]
            read = values[dims] if everything else values[dims[:, None], candidates]
            sums += query[dims] @ read
            rest = at + step
            keep = useful(sums + least[rest:].sum(), sums + most[rest:].sum())
            if not keep.all():
                candidates, sums, everything = candidates[keep], sums[keep], False
        return candidates, sums.astype(np.int64)


def _nth_largest(values: np.ndarray, n: int):
    return np.partition(values, len(values) - n)[len(values) - n]


def _first(n: int):
    """Rows that may be among the ``n`` highest scores; equal scores all stay."""

    def useful(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return high >= _nth_largest(low, n) if len(low) > n else np.ones(len(low), bool)

    return useful


def _in_windows(windows: list[tuple[int, int]], n: int):
    """Rows that may be among the ``n`` highest scores inside one of the windows (both ends included)."""

    def useful(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(low), bool)
        for least, most in windows:
            inside = low[(low >= least) & (high <= most)]
            bound = max(least, _nth_largest(inside, n)) if len(inside) > n else least
            keep |= (high >= bound) & (low <= most)
        return keep

    return useful


def _lowest_first(columns: Columns, at: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` first by descending score, id and row; missing ids (the largest number) come last."""
    return np.lexsort((columns.rows[at], columns.ids[at], -scores))[:n]


def window_of(score: int, least_percent: int) -> tuple[int, int]:
    """Whole scores from ``least_percent`` of ``score`` up to it; none (an empty window) for a negative score."""
    return -(-least_percent * score // 100), score


def _positives(n: int):
    def find(columns: Columns, anchor: int, label: int, vector: np.ndarray, windows: list[int]) -> list[tuple]:
        others = np.nonzero((columns.labels == label) & (columns.rows != anchor))[0]
        at, scores = columns.scan(vector, others, _first(n))
        return [(anchor, None, columns.ids[at[i]], columns.rows[at[i]], scores[i]) for i in _lowest_first(columns, at, scores, n)]

    return find


def _negatives(n: int, least_percent: int):
    def find(columns: Columns, anchor: int, label: int, vector: np.ndarray, windows: list[int]) -> list[tuple]:
        spans = [window_of(score, least_percent) for score in windows]
        at, scores = columns.scan(vector, np.nonzero(columns.labels != label)[0], _in_windows(spans, n))
        out = []
        for least, most in spans:
            inside = np.nonzero((scores >= least) & (scores <= most))[0]
            first = inside[_lowest_first(columns, at[inside], scores[inside], n)]
            out += [(anchor, most, columns.ids[at[i]], columns.rows[at[i]], scores[i]) for i in first]
        return out

    return find


_NO_ID = np.iinfo(np.int64).max


class _Segment:
    def __init__(self, number: int) -> None:
        self.number, self.batches, self.built = number, [], None

    def columns(self, size: int) -> Columns | None:
        if self.built is None:
            self.built = {}
            table = pa.Table.from_batches(self.batches)
            sizes = table["size"].to_numpy()
            for each in np.unique(sizes):
                rows = table.filter(pa.array(sizes == each)).combine_chunks()
                flat = rows["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False) if each else np.zeros(0, np.int64)
                ids = rows["vec_id"].fill_null(_NO_ID).to_numpy()
                vectors = flat.reshape(len(ids), each)
                self.built[int(each)] = Columns(ids, rows["row"].to_numpy(), rows["label"].to_numpy(), vectors)
            self.batches = []
        return self.built.get(size)


def _search(find):
    """Streams rows sorted by segment, a segment's own rows before its visitors, and searches it for each visitor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = None
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers, visits = (batch[c].to_numpy(zero_copy_only=False) for c in ("segment", "visitor"))
            turns = np.nonzero((numbers[1:] != numbers[:-1]) | (visits[1:] != visits[:-1]))[0] + 1
            out: list[tuple] = []
            for begin, end in zip([0, *turns], [*turns, len(numbers)], strict=True):
                if segment is None or segment.number != numbers[begin]:
                    segment = _Segment(numbers[begin])
                part = batch.slice(begin, end - begin)
                if not visits[begin]:
                    segment.batches.append(part)
                    continue
                if not segment.batches and segment.built is None:
                    continue  # a segment without rows of its own
                for anchor in part.select(["row", "label", "size", "vector", "windows"]).to_pylist():
                    columns = segment.columns(anchor["size"])
                    if columns is not None:
                        vector = np.array(anchor["vector"], np.int64)
                        out += find(columns, anchor["row"], anchor["label"], vector, anchor["windows"])
            if out:
                held = [[None if f == "vec_id" and x == _NO_ID else x for x in c] for f, c in zip(_HITS.names, zip(*out), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(held, _HITS, strict=True)], schema=_HITS)

    return run


def quantised(rows: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id, label, vector`` of the rows that take part, each component as ``floor(scale * x)``."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = pick(rows, "vec_id", "label", "embedding").filter(
        F.col("label").isNotNull() & F.col("embedding").isNotNull() & whole
    )
    values = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return usable.select("vec_id", F.col("label").cast("long").alias("label"), values.alias("vector"))


def _visit(table: DataFrame, anchors: DataFrame, segments: int, find) -> DataFrame:
    """Hits of ``anchors`` in all segments of ``table``."""
    names = ["segment", "visitor", "row", "vec_id", "label", "size", "vector", "windows"]
    own = table.withColumn("visitor", F.lit(False)).withColumn("windows", F.lit(None).cast("array<long>"))
    guests = anchors.withColumn("visitor", F.lit(True)).withColumn(
        "segment", F.explode(F.sequence(F.lit(0), F.lit(segments - 1)))
    )
    met = own.select(*names).union(guests.select(*names)).repartition(segments, "segment")
    return met.sortWithinPartitions("segment", "visitor").mapInArrow(_search(find), HITS)


def _ranked(hits: DataFrame, *keys: str, first: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= first)


def mine(
    rows: DataFrame,
    anchors: Column,
    *,
    scale: int = 256,
    positives: int = 5,
    negatives: int = 5,
    least_percent: int = 80,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` from ``vec_id, label, embedding``.

    ``anchors`` says over ``vec_id`` which rows are anchors. Scores are inner products of the components
    ``floor(scale * x)``; higher ones come first, ties by smaller id (a null id last). The ``positives`` first other
    rows of an anchor's label are its positives; for each of them the ``negatives`` first rows of other labels follow
    whose score is between ``least_percent`` per cent of the positive's score and that score.

    Rows with a null label, a null vector, or a null or non-finite component take no part. Vectors of different
    lengths never meet; those without components score 0. A row that repeats is another row: it is a positive of its
    copy, and as an anchor it gives rows of its own. Anchors without positives, and positives without rows in their
    window, give no rows; so does an empty table. Scores that may not fit into 64 bits are an error.
    """
    table = quantised(rows, scale).withColumn("size", F.size("vector")).withColumn("row", F.monotonically_increasing_id())
    table = written(table, "vectors")
    segments = max(-(-table.count() // segment_rows), shuffle_partitions(table))
    dealt = table.withColumn("segment", F.pmod(F.xxhash64("row"), F.lit(segments)).cast("int"))
    asking = table.filter(anchors)
    none = F.lit(None).cast("array<long>")
    near = _visit(dealt, asking.withColumn("windows", none), segments, _positives(positives))
    near = written(_ranked(near, "anchor", first=positives).drop("rank"), "positives")
    windows = near.groupBy("anchor").agg(F.collect_set("score").alias("windows"))
    asking = asking.join(windows, asking["row"] == windows["anchor"]).drop("anchor")
    found = _visit(dealt, asking, segments, _negatives(negatives, least_percent))
    found = written(_ranked(found, "anchor", "window", first=negatives), "negatives")
    ids = table.filter(anchors).select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    pairs = near.select("anchor", F.col("score").alias("window"), F.col("vec_id").alias("positive_id"))
    return (
        found.join(pairs, ["anchor", "window"])
        .join(ids, "anchor")
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("vec_id").alias("negative_id"),
            F.col("window").alias("positive_score"),
            F.col("score").alias("negative_score"),
        )
    )

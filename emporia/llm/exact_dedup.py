"""Exact deduplication against a minimal perfect hash over the digests already kept.

The history is an index table, one row per bucket of digests. A row holds the bit arrays of a minimal perfect hash
(each level places the digests that fall alone on a bit; the rest go to the next level) and, slot by slot, the full
digests with the locator of the copy that stays and the number of copies. A lookup hashes a digest to its only
possible slot and compares all 32 bytes there, so a digest that was never kept is told apart for certain.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import SPACE, parts_for, pick
from emporia.sources.shared import written

BYTES = 32
#: Digests in a bucket; 56 bytes each in the task that builds or reads it.
BUCKET_ROWS = 4096
GAMMA = 2
LEVELS = 24
INDEX = "bucket long, sizes array<int>, bits binary, digests binary, winners array<long>, counts array<long>"
GROUPS = "digest binary, keep_id long, group_size long, known boolean"


def _halves(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = np.ascontiguousarray(digests).view("<u8").reshape(len(digests), 4)
    return words[:, 0], words[:, 1] | np.uint64(1)


def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    mixed = a + b * np.uint64(level + 1)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return (mixed % np.uint64(size)).astype(np.int64)


def build_hash(digests: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Level sizes, bits and the slot of each of the distinct ``digests`` (rows of 32 bytes).

    Digests that share a place on every level (their first 16 bytes would have to be equal) take the last slots.
    """
    a, b = _halves(digests)
    left, sizes, levels = np.arange(len(digests)), [], []
    bit_of = np.full(len(digests), -1, np.int64)
    base = 0
    for level in range(LEVELS):
        if not len(left):
            break
        size = max(GAMMA * len(left), 8)
        at = _place(a[left], b[left], level, size)
        alone = np.bincount(at, minlength=size)[at] == 1
        bits = np.zeros(size, np.uint8)
        bits[at[alone]] = 1
        bit_of[left[alone]] = base + at[alone]
        sizes.append(size)
        levels.append(bits)
        left, base = left[~alone], base + size
    bits = np.concatenate(levels) if levels else np.zeros(0, np.uint8)
    rank = np.cumsum(bits) - bits
    slots = np.where(bit_of >= 0, rank[np.maximum(bit_of, 0)] if len(bits) else 0, 0)
    slots[left] = int(bits.sum()) + np.arange(len(left))
    return sizes, bits, slots


def find_slots(sizes: list[int], bits: np.ndarray, kept: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """The slot that holds each digest, or -1; every answer is checked against the stored 32 bytes."""
    slots = np.full(len(digests), -1, np.int64)
    if not len(kept) or not len(digests):
        return slots
    a, b = _halves(digests)
    rank = np.cumsum(bits, dtype=np.int64) - bits
    left, base = np.arange(len(digests)), 0
    for level, size in enumerate(sizes):
        at = base + _place(a[left], b[left], level, size)
        hit = bits[at] == 1
        slots[left[hit]] = rank[at[hit]]
        left, base = left[~hit], base + size
    found = slots >= 0
    found[found] = (kept[slots[found]] == digests[found]).all(axis=1)
    slots[~found] = -1
    rest = {bytes(kept[i]): i for i in range(int(bits.sum()), len(kept))}
    for i in left if rest else ():
        slots[i] = rest.get(bytes(digests[i]), -1)
    return slots


def _rows(column) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint8).reshape(-1, BYTES)


def _build(table: pa.Table) -> pa.Table:
    digests = _rows(table["digest"])
    sizes, bits, slots = build_hash(digests)
    order = np.argsort(slots)
    return pa.table(
        {
            "bucket": pa.array([table["bucket"][0].as_py()], pa.int64()),
            "sizes": pa.array([sizes], pa.list_(pa.int32())),
            "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()),
            "digests": pa.array([digests[order].tobytes()], pa.binary()),
            "winners": pa.array([table["keep_id"].take(pa.array(order)).to_pylist()], pa.list_(pa.int64())),
            "counts": pa.array([table["group_size"].take(pa.array(order)).to_pylist()], pa.list_(pa.int64())),
        }
    )


def _smaller(a, b):
    return b if a is None else a if b is None else min(a, b)


def _lookup(new: pa.Table, index: pa.Table) -> pa.Table:
    """The groups of one bucket: those of the index with the repeats found for them, and the new ones."""
    ids, sizes = new["keep_id"].to_pylist(), new["group_size"].to_pylist()
    digests = _rows(new["digest"])
    out: dict[str, list] = {"digest": [], "keep_id": [], "group_size": [], "known": []}
    slots = np.full(len(digests), -1, np.int64)
    if index.num_rows:
        row = index.to_pylist()[0]
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(row["sizes"]))
        kept = np.frombuffer(row["digests"], np.uint8).reshape(-1, BYTES)
        slots = find_slots(row["sizes"], bits, kept, digests)
        winners, counts = row["winners"], row["counts"]
        for i in np.nonzero(slots >= 0)[0]:
            at = slots[i]
            winners[at], counts[at] = _smaller(winners[at], ids[i]), counts[at] + sizes[i]
        out["digest"] += [bytes(x) for x in kept]
        out["keep_id"] += winners
        out["group_size"] += counts
        out["known"] += [True] * len(kept)
    for i in np.nonzero(slots < 0)[0]:
        out["digest"].append(bytes(digests[i]))
        out["keep_id"].append(ids[i])
        out["group_size"].append(sizes[i])
        out["known"].append(False)
    return pa.table(
        {
            "digest": pa.array(out["digest"], pa.binary()),
            "keep_id": pa.array(out["keep_id"], pa.int64()),
            "group_size": pa.array(out["group_size"], pa.int64()),
            "known": pa.array(out["known"], pa.bool_()),
        }
    )


def digests_of(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the SHA-256 of each whole text with runs of white space as one space; null counts as empty."""
    text = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), SPACE, " ")
    return pick(docs, "doc_id", "text").select("doc_id", F.unhex(F.sha2(text, 256)).alias("digest"))


def grouped(digests: DataFrame) -> DataFrame:
    """One row per digest: the smallest id and the number of copies, added up before the shuffle."""
    return digests.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


def _bucketed(groups: DataFrame, buckets: int) -> DataFrame:
    return groups.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)))


def build_index(groups: DataFrame, buckets: int) -> DataFrame:
    """The history index over distinct digests; any number of buckets gives the same lookups."""
    return written(_bucketed(groups, buckets).groupBy("bucket").applyInArrow(_build, INDEX), "digest-index")


def merge_groups(new: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """All groups after ``new`` has been looked up: digest, keep_id, group_size, known (was in the index)."""
    pair = _bucketed(new, buckets).groupBy("bucket").cogroup(index.groupBy("bucket"))
    return pair.applyInArrow(_lookup, GROUPS)


def exact_dedup(docs: DataFrame, history_share: float = 0.5) -> DataFrame:
    """Which row of each group of equal texts stays.

    The first ``history_share`` of the range of ids is the history that is indexed; the others arrive after it and
    are looked up. The result is the same for any share. Returns ``doc_id, keep_id, group_size, kept, text_sha256``
    for every row. Of equal texts the smallest id stays; a null id stays only in a group that has no other. Of rows
    that repeat the id that stays, one is kept. Null text counts as empty. An empty table gives no rows.
    """
    digests = written(digests_of(docs), "digests")
    low, high, rows = digests.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1))).first()
    buckets = parts_for(docs, rows, BUCKET_ROWS)
    cut = (low or 0) + int(((high or 0) - (low or 0)) * history_share)
    old = F.coalesce(F.col("doc_id") <= cut, F.lit(False))
    index = build_index(grouped(digests.filter(old)), buckets)
    groups = merge_groups(grouped(digests.filter(~old)), index, buckets)
    copies = digests.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n"))
    return (
        copies.join(groups, "digest")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )



"""Near-duplicate documents by SimHash fingerprints joined on pigeonhole blocks.

A fingerprint of 64 bits is cut into ``distance + 2`` blocks. Two fingerprints that differ in at most ``distance``
bits agree in at least two blocks, so every pair of blocks with its values is a join key of about 32 bits, and pairs
that share a key are verified by their Hamming distance. Keys shared by many distinct fingerprints (balls of
near copies) are not paired: there each fingerprint is filed under its variants, and all that meet at a variant are
linked to the smallest, which is exact and makes a number of rows in proportion to the fingerprints.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import pick
from emporia.sources.shared import written

BITS = 64
#: Distinct fingerprints that a key may have to be paired directly.
PAIRED = 16
_CHUNK = 1 << 16
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _bits(words: list[bytes], reach: int) -> tuple[np.ndarray, int]:
    """How many shingles of ``reach`` words have each bit, and how many shingles there are."""
    body = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = (ends - lengths + 1).tolist()
    digest, spans = xxhash.xxh64_digest, list(zip(starts[: len(words) - reach + 1], ends[reach - 1 :].tolist(), strict=True))
    hashes = b"".join([digest(body[s:e], 42) for s, e in spans])
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
    return bits.sum(axis=0, dtype=np.int64), len(spans)


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """SimHash of the word shingles, repeats included; zero for a text without words.

    The words are split and hashed ``_CHUNK`` bytes at a time, so beside the text itself little is held.
    """
    body = (text or "").encode().lower()  # bytes.lower and split know ASCII letters and white space only
    counts, shingles, words, at = np.zeros(BITS, np.int64), 0, [], 0
    while at < len(body):
        cut = _SPACE.search(body, at + _CHUNK)
        stop = cut.start() if cut else len(body)
        words += body[at:stop].split()
        at = stop
        if len(words) >= shingle_words:
            more, n = _bits(words, shingle_words)
            counts, shingles = counts + more, shingles + n
            words = words[len(words) - shingle_words + 1 :]
    if not shingles and words:
        counts, shingles = _bits(words, len(words))
    return int.from_bytes(np.packbits(counts * 2 > shingles).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle_words: int) -> DataFrame:
    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle_words) for t in texts], dtype="int64")

    return pick(docs, "doc_id", "text").select("doc_id", F.xxhash64("text").alias("version"), of("text").alias("fp"))


def _near(a: Column, b: Column, distance: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= distance


def _blocks(distance: int) -> list[int]:
    """Masks of all pairs of blocks, as signed 64-bit numbers."""
    count = distance + 2
    edges = [BITS * i // count for i in range(count + 1)]
    masks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:], strict=False)]
    pairs = [x | y for x, y in combinations(masks, 2)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in pairs]


def _variants(distance: int) -> Column:
    """``fp`` with up to half of ``distance`` bits flipped (rounded up); ``inner`` where rounding down is enough."""
    bits = F.array(*[F.lit(1 << b if b < BITS - 1 else -(1 << b)) for b in range(BITS)])
    made = [F.array(F.lit(0).cast("long"))]
    for _ in range(distance - distance // 2):
        step = F.flatten(F.transform(made[-1], lambda m: F.transform(bits, lambda b: m.bitwiseXOR(b))))
        made.append(F.array_distinct(F.concat(made[-1], step)))
    inner = made[distance // 2]
    return F.transform(
        made[-1],
        lambda flip: F.struct(F.col("fp").bitwiseXOR(flip).alias("variant"), F.array_contains(inner, flip).alias("inner")),
    )


def links(prints: DataFrame, distance: int) -> DataFrame:
    """Links ``a < b`` between distinct fingerprints ``fp`` that reach exactly the pairs within ``distance``.

    Every link is a pair within ``distance`` bits, and any such pair is joined by a path of links.
    """
    keyed = written(
        prints.select("fp", F.posexplode(F.array(*[F.lit(m) for m in _blocks(distance)])).alias("blocks", "mask")).select(
            "fp", "blocks", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value")
        ),
        "blocks",
    )
    shared = keyed.groupBy("blocks", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    met = written(keyed.join(shared, ["blocks", "value"]), "shared-blocks")
    left = met.filter(F.col("n") <= PAIRED).select("blocks", "value", F.col("fp").alias("a"))
    right = met.filter(F.col("n") <= PAIRED).select("blocks", "value", F.col("fp").alias("b"))
    paired = left.join(right, ["blocks", "value"]).filter((F.col("a") < F.col("b")) & _near(F.col("a"), F.col("b"), distance))
    crowded = met.filter(F.col("n") > PAIRED).select("fp").distinct()
    return paired.select("a", "b").union(_stars(crowded, distance)).distinct()


def _stars(crowded: DataFrame, distance: int) -> DataFrame:
    """Links at each variant from the smallest fingerprint within half the distance to all others filed there.

    Two fingerprints within the distance meet at a variant, where the two ways add up to the distance at most. A
    variant has few distinct fingerprints by its geometry: 65 for a distance of 2, 2,081 for 3 or 4.
    """
    filed = crowded.select("fp", F.inline(_variants(distance)))
    at = filed.groupBy("variant").agg(
        F.min(F.when(F.col("inner"), F.col("fp"))).alias("low"), F.collect_set("fp").alias("fps")
    )
    met = at.filter(F.col("low").isNotNull() & (F.size("fps") > 1)).select("low", F.explode("fps").alias("fp"))
    pairs = met.filter(F.col("fp") != F.col("low")).select(F.least("low", "fp").alias("a"), F.greatest("low", "fp").alias("b"))
    return pairs.filter(_near(F.col("a"), F.col("b"), distance))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``): the smallest node that it reaches.

    Alternates two star operations until nothing changes: neighbours above a node move to the smallest of its
    neighbourhood, then those below it do. The rounds grow with the logarithm of the longest path. Every round is
    a written table; a node with very many neighbours only meets a minimum and a join that adaptive execution splits.
    """
    edges = written(edges.select("a", "b"), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        # after the large star every edge leads from a node down to a smaller one
        large = written(large.filter(F.col("a") != F.col("b")).distinct(), "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        moved = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = moved.union(low.select("a", F.col("low").alias("b"))).filter(F.col("a") != F.col("b"))
        edges = written(small.distinct(), "small-star")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def classes(prints: DataFrame, distance: int) -> DataFrame:
    """``fp, root, component_id, copies`` for each distinct fingerprint of ``prints`` (``doc_id, fp``)."""
    if not 0 <= distance <= 4:
        raise ValueError("distance must be from 0 to 4 bits")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    distinct = written(distinct, "distinct-prints")
    if not distance:
        return distinct.select("fp", F.col("fp").alias("root"), F.col("first_id").alias("component_id"), "copies")
    roots = components(links(distinct, distance)).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = written(rooted, "rooted-prints")
    first = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(first, "root").select("fp", "root", "component_id", "copies")


def simhash_groups(docs: DataFrame, shingle_words: int = 3, distance: int = 2) -> DataFrame:
    """``doc_id, fp, component_id, copies`` for every row.

    Words are runs of characters other than ASCII white space, A-Z lower-cased. Texts without words, null ones too,
    have fingerprint zero and are linked like any other. ``component_id`` is the smallest id reachable by links of
    at most ``distance`` bits (null ids are passed over; null when a component has no other) and ``copies`` the
    number of rows with the same fingerprint. Repeated rows each appear. An empty table gives no rows. A very long
    text is hashed in pieces.
    """
    prints = written(fingerprints(docs, shingle_words), "fingerprints")
    return prints.join(classes(prints, distance), "fp").select("doc_id", "fp", "component_id", "copies")


def representatives(docs: DataFrame, shingle_words: int = 3, distance: int = 2) -> DataFrame:
    """``doc_id, version`` of the one row of each component that stays; ``version`` is the 64-bit hash of its text.

    The smallest id stays; among rows with the same id, and where all ids are null, the smallest version.
    """
    prints = written(fingerprints(docs, shingle_words), "fingerprints")
    rooted = prints.join(classes(prints, distance).select("fp", "root"), "fp")
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "version")
    return rooted.groupBy("root").agg(F.min(order).alias("row")).select("row.doc_id", "row.version")


def hex_print(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))

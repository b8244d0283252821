"""Benchmark decontamination with an FM-index per training shard.

A shard is a run of documents of up to ``SHARD_WORDS`` words inside one task; a document that is longer lies in several
shards, which overlap by the longest window less a word. Words that no test phrase uses separate runs of words, as
document ends do. The test phrases are the windows of the benchmark items; they are
searched backwards through the shard's wavelet ranks, all at once, occurrences are located by sampled positions,
and the windows that hit a document are merged to removal spans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import pick
from emporia.llm.fm_index import FmIndex
from emporia.sources.shared import written

WINDOW = 10
SHARD_WORDS = 1 << 19
#: Benchmark words that are searched in one pass over the documents; more make more passes.
BLOCK_WORDS = 1_000_000
# letters and digits of ASCII, and everything beyond ASCII, are word characters
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_WORD_CLASS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD = regex.compile(_WORD_CLASS)
FOUND = "n_words long, spans array<struct<begin:long,end:long>>, items array<long>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


#: Bytes of a text that are split into words at once; a piece ends with a word.
_PIECE = 1 << 20
_GAP = regex.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def codes_of(text: str | None, vocabulary: dict[bytes, int]) -> np.ndarray:
    """The number of every word, 0 for words that no window has; the words themselves are held piece by piece."""
    body, at, out, get = (text or "").encode("utf-8", "surrogatepass"), 0, [np.zeros(0, np.int64)], vocabulary.get
    while at < len(body):
        gap = _GAP.search(body, at + _PIECE) if len(body) - at > _PIECE else None
        stop = gap.start() if gap else len(body)
        words = body[at:stop].translate(_TABLE).split()
        out.append(np.fromiter((get(w, 0) for w in words), np.int64, len(words)))
        at = stop
    return np.concatenate(out) if len(out) != 2 else out[1]


@dataclass
class Phrases:
    """Distinct windows of a block of benchmark items, and the items that each comes from."""

    vocabulary: dict[bytes, int]
    codes: np.ndarray
    lengths: np.ndarray
    item_starts: np.ndarray
    items: np.ndarray


def phrases_of(items: list[tuple[int | None, str | None]], window: int = WINDOW) -> Phrases:
    """Windows of ``window`` consecutive words; an item of fewer words, but not none, is one window."""
    vocabulary: dict[bytes, int] = {}
    found: dict[tuple[int, ...], set[int]] = {}
    for item_id, text in items:
        codes = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
        for i in range(max(1, len(codes) - window + 1) if codes else 0):
            held = found.setdefault(tuple(codes[i : i + window]), set())
            if item_id is not None:
                held.add(item_id)
    matrix = np.zeros((len(found), window), np.int64)
    for i, codes in enumerate(found):
        matrix[i, : len(codes)] = codes
    counts = [len(x) for x in found.values()]
    return Phrases(
        vocabulary,
        matrix,
        np.array([len(x) for x in found], np.int64),
        np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]).astype(np.int64),
        np.array([i for x in found.values() for i in sorted(x)], np.int64),
    )


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers ``start, start + 1, ...``, ``count`` of them, for each start."""
    total = int(counts.sum())
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    return np.arange(total) + shift


def search_shard(codes: list[np.ndarray], phrases: Phrases) -> list[tuple[list[tuple[int, int]], list[int]]]:
    """Merged spans of words and item ids for each document of a shard."""
    lengths = np.array([len(c) for c in codes], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    joined = np.zeros(int(starts[-1]), np.int64)
    for at, c in zip(starts, codes, strict=False):
        joined[at : at + len(c)] = c
    none: list[tuple[list[tuple[int, int]], list[int]]] = [([], []) for _ in codes]
    if not joined.any() or not len(phrases.codes):
        return none
    index = FmIndex(joined, len(phrases.vocabulary) + 1)
    begin, end = index.search(phrases.codes, phrases.lengths)
    counts = end - begin
    if not counts.any():
        return none
    which = np.repeat(np.arange(len(counts)), counts)
    at = index.locate(_spread(begin, counts))
    cover = np.zeros(len(joined) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + phrases.lengths[which], -1)
    hit = np.concatenate([[False], np.cumsum(cover)[:-1] > 0, [False]])
    edges = np.nonzero(hit[1:] != hit[:-1])[0]
    for b, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        doc = int(np.searchsorted(starts, b, "right")) - 1
        none[doc][0].append((b - int(starts[doc]), e - int(starts[doc])))
    pairs = np.unique(np.stack([np.searchsorted(starts, at, "right") - 1, which]), axis=1)
    sizes = (phrases.item_starts[1:] - phrases.item_starts[:-1])[pairs[1]]
    docs = np.repeat(pairs[0], sizes)
    for doc, item in np.unique(np.stack([docs, phrases.items[_spread(phrases.item_starts[pairs[1]], sizes)]]), axis=1).T:
        none[doc][1].append(int(item))
    return none


def _merged(pieces) -> list[tuple[int, int]]:
    """Spans in order, those that touch as one."""
    out: list[list[int]] = []
    for begin, end in sorted(pieces):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(b, e) for b, e in out]


def _search_texts(texts: list[str | None], phrases: Phrases) -> list[tuple]:
    """Number of words, hit spans and items of each text."""
    sizes: list[int] = []
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[set[int]] = [set() for _ in texts]
    shard: list[tuple[int, int, np.ndarray]] = []
    size, overlap = 0, int(phrases.lengths.max(initial=1)) - 1

    def flush() -> None:
        for (doc, shift, _), (found, named) in zip(shard, search_shard([c for _, _, c in shard], phrases), strict=True):
            spans[doc] += [(b + shift, e + shift) for b, e in found]
            items[doc].update(named)
        shard.clear()

    for doc, text in enumerate(texts):
        codes = codes_of(text, phrases.vocabulary)
        sizes.append(len(codes))
        for at in range(0, max(len(codes), 1), SHARD_WORDS):
            shard.append((doc, at, codes[at : at + SHARD_WORDS + overlap]))
            size += len(shard[-1][2])
            if size >= SHARD_WORDS:
                flush()
                size = 0
    flush()
    return [(n, _merged(s), sorted(i)) for n, s, i in zip(sizes, spans, items, strict=True)]


def searcher(phrases: Phrases):
    """A column function from a text to its number of words, hit spans and items."""

    @F.pandas_udf(FOUND)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = _search_texts(list(texts), phrases)
            yield pd.DataFrame(
                {
                    "n_words": [n for n, _, _ in rows],
                    "spans": [[{"begin": b, "end": e} for b, e in spans] for _, spans, _ in rows],
                    "items": [items for _, _, items in rows],
                }
            )

    return search


def blocks_of(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> list[DataFrame]:
    """The benchmark in parts of about ``block_words`` words, by a hash of the item."""
    items = pick(benchmark, "item_id", "text")
    words = items.agg(F.sum(F.regexp_count("text", F.lit(_WORD_CLASS)).cast("long"))).first()[0] or 0
    count = max(1, -(-words // block_words))
    if count == 1:
        return [items]
    return [items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == i) for i in range(count)]


MERGED = "n_hit long, n_items long, items_sha256 string, spans array<struct<begin:long,end:long>>, items array<long>"


def _merge(spans: pd.Series, items: pd.Series) -> pd.DataFrame:
    """Spans of all blocks merged, ids sorted as strings."""
    rows = []
    for pieces, ids in zip(spans, items, strict=True):
        merged = _merged((x["begin"], x["end"]) for x in pieces)
        named = sorted({str(int(i)) for i in ids})
        rows.append(
            {
                "n_hit": sum(e - b for b, e in merged),
                "n_items": len(named),
                "items_sha256": hashlib.sha256(",".join(named).encode()).hexdigest(),
                "spans": [{"begin": b, "end": e} for b, e in merged],
                "items": [int(i) for i in named],
            }
        )
    return pd.DataFrame(rows, columns=["n_hit", "n_items", "items_sha256", "spans", "items"])


def _all_blocks(rows: DataFrame, blocks: list[DataFrame]) -> DataFrame:
    """Hits of several blocks, searched one after the other and put together by document."""
    rows = rows.withColumn("version", F.xxhash64("text"))
    each = []
    for block in blocks:
        search = searcher(phrases_of([tuple(r) for r in block.collect()]))
        hits = rows.withColumn("f", search("text")).select("doc_id", "version", "f.spans", "f.items")
        each.append(written(hits.filter(F.size("spans") > 0).distinct(), "block-hits"))
    hits = each[0]
    for more in each[1:]:
        hits = hits.union(more)
    hits = hits.groupBy("doc_id", "version").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items")
    )
    hits = hits.toDF("h_id", "h_version", "h_spans", "h_items")
    same = F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("version") == F.col("h_version"))
    counted = rows.withColumn("f", searcher(phrases_of([]))("text")).join(hits, same, "left")
    return counted.select(
        "doc_id",
        "text",
        "f.n_words",
        F.coalesce("h_spans", F.col("f.spans")).alias("spans"),
        F.coalesce("h_items", F.col("f.items")).alias("items"),
    )


def find_contamination(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, spans, items`` for every row.

    Words are A-Z lower-cased runs of ASCII letters, digits and all characters beyond ASCII. A document word inside
    any occurrence of a window is hit; ``spans`` are the merged hits as word numbers, end exclusive. Null and empty
    texts have no words, and items without words no windows. An item without an id hits but is not listed; rows
    with the same item id count as one item. Repeated rows each appear; empty tables on either side are fine. Of a very
    long text a task holds the number of each word, and an index of ``SHARD_WORDS`` of them at a time.
    """
    rows = pick(docs, "doc_id", "text")
    blocks = blocks_of(benchmark, block_words)
    if len(blocks) == 1:
        search = searcher(phrases_of([tuple(r) for r in blocks[0].collect()]))
        found = rows.withColumn("f", search("text")).select("doc_id", "f.n_words", "f.spans", "f.items")
    else:
        found = _all_blocks(rows, blocks)
    merged = found.withColumn("m", F.pandas_udf(_merge, MERGED)("spans", "items"))
    return merged.select("doc_id", "n_words", "m.n_hit", "m.n_items", "m.items_sha256", "m.spans", "m.items")


def cut_spans(text: str | None, spans: list[tuple[int, int]]) -> str:
    """The text without the characters of the words in ``spans``; a line break stands where words were removed."""
    at = [m.span() for m in _WORD.finditer(text or "")]
    out, done = [], 0
    for begin, end in spans:
        out.append((text or "")[done : at[begin][0]])
        done = at[end - 1][1]
    out.append((text or "")[done:])
    return "\n".join(out)


def clean_texts(texts: list[str | None], phrases: Phrases) -> list[str | None]:
    """Texts without the spans that hit; searched again where something went, as its neighbours now meet."""
    out, left = list(texts), list(range(len(texts)))
    while left:
        found = _search_texts([out[i] for i in left], phrases)
        left = [i for i, (_, spans, _) in zip(left, found, strict=True) if spans]
        spans_of = [spans for _, spans, _ in found if spans]
        for i, spans in zip(left, spans_of, strict=True):
            out[i] = cut_spans(out[i], spans)
    return out


def remove_contamination(rows: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``rows`` with the benchmark's windows cut out of column ``text``; all other columns and rows stay."""

    def cleaner(phrases: Phrases):
        @F.pandas_udf("string")
        def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series(clean_texts(list(texts), phrases), dtype=object)

        return clean

    blocks = blocks_of(benchmark, block_words)
    if len(blocks) == 1:
        return rows.withColumn("text", cleaner(phrases_of([tuple(r) for r in blocks[0].collect()]))("text"))
    while True:  # what one block cuts may let words meet that another block searches for
        before = rows
        for block in blocks:
            clean = cleaner(phrases_of([tuple(r) for r in block.collect()]))
            rows = written(rows.withColumn("text", clean("text")), "cleaned")
        # by hash: a window of one letter leaves a line break, and the length is the same
        state = [x.agg(F.sum(F.xxhash64("text").cast("decimal(38,0)"))).first()[0] for x in (before, rows)]
        if state[0] == state[1]:
            return rows

"""Language-model scores of documents: add-one unigrams and a hashed maximum-entropy model.

One pass turns every text into token numbers of its shard (about ``SHARD_TOKENS`` tokens of one task) and every shard
into a dictionary. The dictionaries meet by token, where counts over all training documents are added up, and go back
to their shards. So what moves is a row for each distinct token of a shard, not one for each token. The model is
trained on all training documents: in each round every task takes gradient steps from the same weights over its part,
and its moves of the rows of weights are averaged over the tasks that moved them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emporia.llm import maxent, token_hash
from emporia.llm.common import held_out, pick
from emporia.sources.shared import written

#: Tokens of a shard, unless a single text has more.
SHARD_TOKENS = 1 << 21
#: Rounds of training; each sees a part of the training documents once.
ROUNDS = 3
#: Rows of weights that travel together.
BLOCK_ROWS = 128
HELD_OUT_PARTS = 7
_TEXTS = 512

CODED = "shard long, place int, h1 long, h2 int, ending int, n long, doc_id long, held_out boolean, tokens long, ids binary"
_CODED = pa.schema(
    [
        ("shard", pa.int64()), ("place", pa.int32()), ("h1", pa.int64()), ("h2", pa.int32()), ("ending", pa.int32()),
        ("n", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("tokens", pa.int64()), ("ids", pa.binary()),
    ]
)


def _record(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    made = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _CODED]
    return pa.RecordBatch.from_arrays(made, schema=_CODED)


def _number(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each token, alike for equal ones, and the first place of each number."""
    codes, unique = pd.factorize(h1)
    first = np.empty(len(unique), np.int64)
    first[codes[::-1]] = np.arange(len(h1))[::-1]
    if (h2[first][codes] == h2).all():
        return codes, first
    _, first, codes = np.unique(np.stack([h1, h2.astype(np.uint64)]), axis=1, return_index=True, return_inverse=True)
    return codes.reshape(-1), first


def pack(ids: np.ndarray) -> bytes:
    """Numbers below 2**32, which are small for frequent tokens, deflated by halves."""
    return zlib.compress(ids.astype(np.uint16).tobytes() + (ids >> 16).astype(np.uint16).tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    halves = np.frombuffer(zlib.decompress(packed), np.uint16).reshape(2, -1).astype(np.int64)
    return halves[0] | halves[1] << 16


def _shard(number: int, ids: list, held: list, parts: list[token_hash.Tokens]) -> Iterator[pa.RecordBatch]:
    """The dictionary of a shard, frequent tokens first, and its documents as numbers of the dictionary."""
    h1 = np.concatenate([p.h1 for p in parts])
    h2 = np.concatenate([p.h2 for p in parts]).astype(np.uint32)
    ending = np.concatenate([p.ending for p in parts])
    lengths = np.concatenate([np.diff(p.bounds) for p in parts])
    codes, first = _number(h1, h2)
    trained = np.repeat(~np.array(held, bool), lengths)
    counts = np.bincount(codes, minlength=len(first))
    order = np.argsort(-counts, kind="stable")
    place = np.empty(len(first), np.int32)
    place[order] = np.arange(len(first), dtype=np.int32)
    known = np.bincount(codes[trained], minlength=len(first))
    first, known = first[order], known[order]
    yield _record(
        shard=np.full(len(first), number), place=np.arange(len(first), dtype=np.int32), h1=h1[first].view(np.int64),
        h2=h2[first].view(np.int32), ending=ending[first], n=known,
    )
    places, bounds = place[codes], np.concatenate([[0], np.cumsum(lengths)])
    for at in range(0, len(ids), _TEXTS):
        part = range(at, min(at + _TEXTS, len(ids)))
        yield _record(
            shard=np.full(len(part), number), doc_id=[ids[i] for i in part], held_out=[held[i] for i in part],
            tokens=[int(lengths[i]) for i in part], ids=[pack(places[bounds[i] : bounds[i + 1]]) for i in part],
        )


def _code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, made = TaskContext.get().partitionId(), 0
    ids, held, parts, size = [], [], [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, _TEXTS):
            part = batch.slice(at, _TEXTS)
            parts.append(token_hash.tokens(part["text"]))
            ids += part["doc_id"].to_pylist()
            held += part["held_out"].to_pylist()
            size += len(parts[-1].h1)
            if size >= SHARD_TOKENS:
                yield from _shard(task << 32 | made, ids, held, parts)
                ids, held, parts, size, made = [], [], [], 0, made + 1
    if ids:
        yield from _shard(task << 32 | made, ids, held, parts)


@dataclass
class Counts:
    """Training tokens, distinct ones, and for the open classes the counts plus one of all words outside the head."""

    tokens: int
    distinct: int
    model: maxent.Model
    open_totals: np.ndarray


def summarise(known: DataFrame, head_words: int = maxent.HEAD_CLASSES * maxent.SLOTS) -> Counts:
    """Totals and the untrained model from ``h1, ending, c``, one row for each training token."""
    total, distinct = known.agg(F.sum("c"), F.count(F.lit(1))).first()
    top = known.orderBy(F.desc("c"), "h1").limit(head_words).select("h1", "ending", "c").toPandas()
    endings = known.groupBy("ending").agg(F.sum(F.col("c") + 1).alias("c")).toPandas()  # at most 65,536 endings
    open_totals = np.ones(maxent.OPEN_CLASSES)
    for table, sign in ((endings, 1), (top, -1)):
        each = table["c"].to_numpy(np.float64) + (sign < 0)
        np.add.at(open_totals, maxent.open_class(table["ending"].to_numpy(np.int64)) - maxent.HEAD_CLASSES, sign * each)
    hashes = top["h1"].to_numpy(np.int64).view(np.uint64)
    head = maxent.Head.of(hashes, top["ending"].to_numpy(np.int64))
    counts = top["c"].to_numpy(np.float64)[np.argsort(hashes)]
    return Counts(int(total or 0), int(distinct), maxent.Model.start(head, counts, open_totals), open_totals)


MOVES = "tab int, block int, rows binary, moves binary, paces binary"


def _moves(shared):
    """Gradient steps of one task over its documents, and what they moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = shared.value
        tables, paces = [t.copy() for t in start.tables], [m.copy() for m in start.moved]
        model = maxent.Model(start.head, start.class_bias, start.slot_bias, tables, paces)
        touched = [np.zeros(len(t), np.int64) for t in tables]
        for batch in batches:
            for at in range(0, batch.num_rows, _TEXTS):
                maxent.learn(model, token_hash.tokens(batch.slice(at, _TEXTS)["text"], hashes=1), touched)
        for number, (before, after) in enumerate(zip(start.tables, tables, strict=True)):
            for at in range(0, len(before), BLOCK_ROWS):
                rows = np.nonzero(touched[number][at : at + BLOCK_ROWS])[0]
                if len(rows):
                    moved = (after[at + rows] - before[at + rows]).tobytes()
                    pace = (paces[number][at + rows] - start.moved[number][at + rows]).tobytes()
                    row = [[number], [at // BLOCK_ROWS], [rows.astype(np.int32).tobytes()], [moved], [pace]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(row, (pa.int32(), pa.int32(), *[pa.binary()] * 3), strict=True)],
                        names=["tab", "block", "rows", "moves", "paces"],
                    )

    return run


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Moves of the same block added up as they come, divided by the number of tasks that made them."""
    held: dict[tuple[int, int], list[np.ndarray]] = {}
    widths = (maxent.CLASSES, maxent.SLOTS)
    for batch in batches:
        for row in batch.to_pylist():
            key = (row["tab"], row["block"])
            if key not in held:
                held[key] = [np.zeros((BLOCK_ROWS, widths[key[0]]), np.float32), np.zeros(BLOCK_ROWS, np.float32), np.zeros(BLOCK_ROWS)]
            at = np.frombuffer(row["rows"], np.int32)
            held[key][0][at] += np.frombuffer(row["moves"], np.float32).reshape(len(at), -1)
            held[key][1][at] += np.frombuffer(row["paces"], np.float32)
            held[key][2][at] += 1
    for (table, block), (moves, paces, times) in held.items():
        moves /= np.maximum(times, 1)[:, None]
        row = [[table], [block], [times.astype(np.int32).tobytes()], [moves.astype(np.float32).tobytes()], [paces.tobytes()]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(row, (pa.int32(), pa.int32(), *[pa.binary()] * 3), strict=True)],
            names=["tab", "block", "rows", "moves", "paces"],
        )


def train(learned: DataFrame, model: maxent.Model, rounds: int = ROUNDS) -> maxent.Model:
    """Weights from all rows of ``text, turn``; the rows of a turn are one round.

    A round runs as many tasks as the cluster has cores, so what they send is bounded by the model times the cores.
    """
    context = learned.sparkSession.sparkContext
    tasks = context.defaultParallelism
    for turn in range(rounds):
        shared = context.broadcast(model)
        part = learned.filter(F.col("turn") == turn).select("text").coalesce(tasks)
        moves = part.mapInArrow(_moves(shared), MOVES).repartition(tasks, "tab", "block").mapInArrow(_averaged, MOVES)
        for row in written(moves, f"moves-{turn}").toLocalIterator():
            at, width = row["block"] * BLOCK_ROWS, model.tables[row["tab"]].shape[1]
            table, pace = model.tables[row["tab"]], model.moved[row["tab"]]
            table[at : at + BLOCK_ROWS] += np.frombuffer(row["moves"], np.float32).reshape(-1, width)
            pace[at : at + BLOCK_ROWS] += np.frombuffer(row["paces"], np.float32)
        shared.unpersist()
    return model


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_SCORES = pa.schema(
    [
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
    ]
)


class _Dictionary:
    """A shard's tokens by their number, gathered from batches that may come in any order."""

    def __init__(self, counts: Counts) -> None:
        self.counts, self.parts, self.ready = counts, [], False

    def add(self, batch: pa.RecordBatch) -> None:
        self.parts.append([batch[c].to_numpy(zero_copy_only=False) for c in ("place", "h1", "ending", "c")])

    def close(self) -> None:
        place, h1, ending, c = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.argsort(place)
        self.h1, self.ending = h1[order].astype(np.int64).view(np.uint64), ending[order].astype(np.int64)
        self.n = c[order].astype(np.float64)
        total = self.counts
        self.base = np.log10((self.n + 1) / (total.tokens + total.distinct + 1))
        # words of the open classes share their class by their counts; the head's are part of the model
        number, kind = maxent.parts(total.model.head, token_hash.Tokens(self.h1, self.h1, self.ending, None))
        open_ = np.maximum(kind - maxent.HEAD_CLASSES, 0)
        self.within = np.where(number < 0, np.log10((self.n + 1) / total.open_totals[open_]), 0.0)
        self.parts, self.ready = [], True


def _score(shared):
    """Streams rows sorted by shard, a shard's dictionary before its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, shard, held = shared.value, None, None
        for batch in batches:
            shards = batch["shard"].to_numpy(zero_copy_only=False)
            texts = ~batch["ids"].is_null().to_numpy(zero_copy_only=False)
            turns = np.nonzero((shards[1:] != shards[:-1]) | (texts[1:] != texts[:-1]))[0] + 1
            for begin, end in zip([0, *turns], [*turns, len(shards)], strict=True):
                if begin == end:
                    continue
                if shard != shards[begin]:
                    shard, held = shards[begin], _Dictionary(counts)
                part = batch.slice(begin, end - begin)
                if not texts[begin]:
                    held.add(part)
                    continue
                if not held.ready:
                    held.close()
                for at in range(0, part.num_rows, _TEXTS):
                    yield _scored(counts, held, part.slice(at, _TEXTS))

    return run


def _scored(counts: Counts, held: _Dictionary, rows: pa.RecordBatch) -> pa.RecordBatch:
    ids = [unpack(x) for x in rows["ids"].to_pylist()]
    lengths = np.array([len(x) for x in ids])
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    at = np.concatenate(ids)
    tokens = token_hash.Tokens(held.h1[at], held.h1[at], held.ending[at], bounds)
    logs = maxent.log10_parts(counts.model, tokens) + held.within[at]
    sums = [np.add.reduceat(x, bounds[:-1]) for x in ((held.n[at] > 0).astype(np.int64), held.base[at], logs)]
    made = [rows["doc_id"], rows["held_out"], lengths, sums[0], np.full(len(ids), counts.tokens), sums[1], sums[2]]
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(made, _SCORES, strict=True)], schema=_SCORES)


def lm_scores(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``doc_id, text``.

    Tokens are runs other than ASCII white space, A-Z lower-cased, and one end for each text. Documents whose CRC-32
    leaves 2 modulo ``HELD_OUT_PARTS``, and those without an id, are held out; all others are learned from.
    ``base_score`` is the log10 probability by counts plus one, ``score`` that of the model; ``n_known`` counts tokens
    that occur in training. Null and empty texts are their end alone. Rows that repeat are learned from and scored
    each; an empty table gives no rows. With nothing to learn from all counts are zero, the base score is 0 and the
    model falls back on equal open classes. Memory is bounded by a shard and by the longest text's tokens.

    A token has a row for each shard in the exchange of counts, so its largest group has as many rows as there are
    shards.
    """
    context = docs.sparkSession.sparkContext
    texts = pick(docs, "doc_id", "text").withColumn("held_out", held_out(F.col("doc_id"), HELD_OUT_PARTS))
    coded = written(texts.mapInArrow(_code, CODED), "coded-texts")
    words = coded.filter(F.col("ids").isNull()).select("shard", "place", "h1", "h2", "ending", "n")
    same = Window.partitionBy("h1", "h2")
    counted = words.select(
        "shard", "place", "h1", "ending", F.sum("n").over(same).alias("c"),
        (F.row_number().over(same.orderBy("shard")) == 1).alias("once"),
    )
    counted = written(counted, "token-counts")
    counts = summarise(counted.filter(F.col("once") & (F.col("c") > 0)))
    turn = F.pmod(F.xxhash64(F.lit("turn"), "doc_id"), F.lit(rounds))
    learned = texts.filter(~F.col("held_out")).select("text", turn.alias("turn"))
    train(learned, counts.model, rounds)
    shards = coded.select("shard").distinct().count()
    rows = coded.filter(F.col("ids").isNotNull()).select("shard", "ids", "doc_id", "held_out")
    met = counted.select("shard", "place", "h1", "ending", "c").unionByName(rows, allowMissingColumns=True)
    dealt = met.repartition(max(1, 4 * shards), "shard").sortWithinPartitions("shard", F.col("ids").isNotNull())
    return dealt.mapInArrow(_score(context.broadcast(counts)), SCORES)

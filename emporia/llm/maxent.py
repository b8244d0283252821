"""A hashed maximum-entropy model of the next token with a class-factored softmax, in numpy.

The frequent words (the head) are dealt out to classes of ``SLOTS`` words with like endings; all other words belong to
open classes told by their last two bytes. A token's probability is that of its class times that of the token within
its class. Features of the context (the word before, the two words before together, the word two back and the one
three back, each skipping those between) hash to rows of weights: one weight for each class, and, together with a
head class, one for each of its slots. Words of an open class share its probability by their counts plus one, with one
part for all words that were never met, so the probabilities of all words add up to one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from emporia.llm.token_hash import Tokens

HEAD_CLASSES, SLOTS, OPEN_CLASSES = 24, 32, 8
CLASSES = HEAD_CLASSES + OPEN_CLASSES
ROW_BITS = 15
#: Tokens of a gradient step.
BATCH = 8_192
RATE = 0.3
_START = np.uint64(0x165667B19E3779F9)
_SALTS = [np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63)]
FEATURES = len(_SALTS)


def open_class(ending: np.ndarray) -> np.ndarray:
    """The open class of words by their last two bytes."""
    spread = (ending.astype(np.uint64) + np.uint64(1)) * _SALTS[0]
    return HEAD_CLASSES + ((spread >> np.uint64(40)) % np.uint64(OPEN_CLASSES)).astype(np.int64)


@dataclass
class Head:
    """The frequent words: sorted hashes with the number (class times ``SLOTS`` plus slot) of each."""

    hashes: np.ndarray
    numbers: np.ndarray

    @staticmethod
    def of(hashes: np.ndarray, endings: np.ndarray) -> Head:
        """Words with like endings come to the same class."""
        order = np.lexsort((hashes, endings))
        size = -(-len(hashes) // HEAD_CLASSES) if len(hashes) else 1
        numbers = np.empty(len(hashes), np.int64)
        at = np.arange(len(hashes))
        numbers[order] = at // size * SLOTS + at % size
        by_hash = np.argsort(hashes)
        return Head(hashes[by_hash], numbers[by_hash])

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for those that are not in the head."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.numbers[at], -1)


@dataclass
class Model:
    """Weights: ``tables[0]`` has rows of class weights, ``tables[1]`` rows of slot weights; biases start from counts."""

    head: Head
    class_bias: np.ndarray
    slot_bias: np.ndarray
    tables: list[np.ndarray] = field(default_factory=lambda: [np.zeros((1 << ROW_BITS, n), np.float32) for n in (CLASSES, SLOTS)])
    #: Sums of squared gradients by row, which slow down rows that moved much.
    moved: list[np.ndarray] = field(default_factory=lambda: [np.full(1 << ROW_BITS, 1e-6, np.float32) for _ in range(2)])

    @staticmethod
    def start(head: Head, counts: np.ndarray, open_totals: np.ndarray) -> Model:
        """Biases from the counts of the head's words (in the order of ``head``) and of the open classes."""
        slots = np.full(HEAD_CLASSES * SLOTS, -np.inf, np.float32)
        slots[head.numbers] = np.log(counts + 1.0)
        totals = np.zeros(HEAD_CLASSES)
        np.add.at(totals, head.numbers // SLOTS, counts + 1.0)
        with np.errstate(divide="ignore"):
            classes = np.log(np.concatenate([totals, open_totals]))
        return Model(head, classes.astype(np.float32), slots.reshape(HEAD_CLASSES, SLOTS))


def context(tokens: Tokens) -> np.ndarray:
    """Hashes of the features of each token's context, one row for each feature."""
    n = len(tokens.h1)
    at = np.arange(n) - np.repeat(tokens.bounds[:-1], np.diff(tokens.bounds))
    back = [np.full(n, _START) for _ in range(3)]
    for k in range(3):
        back[k][k + 1 :] = tokens.h1[: n - k - 1] if n > k else tokens.h1[:0]
        back[k][at <= k] = _START
    joint = back[0] * _SALTS[1] + (back[1] ^ (back[1] >> np.uint64(29))) * _SALTS[2]
    return np.stack([x * s for x, s in zip((back[0], joint, back[1], back[2]), _SALTS, strict=True)])


def _rows(features: np.ndarray, with_class: np.ndarray | None = None) -> np.ndarray:
    if with_class is not None:
        features = (features ^ (features >> np.uint64(31))) * (with_class.astype(np.uint64) * _SALTS[3] + _SALTS[2] | np.uint64(1))
    return (features >> np.uint64(64 - ROW_BITS)).astype(np.int64)


def _softmax(table: np.ndarray, rows: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Probabilities from the bias and the rows of all features."""
    made = table.take(rows[0], axis=0)
    room = np.empty_like(made)
    for each in rows[1:]:
        made += table.take(each, axis=0, out=room, mode="clip")
    made += bias
    made -= made.max(axis=1, keepdims=True)
    np.exp(made, out=made)
    made /= made.sum(axis=1, keepdims=True)
    return made


def parts(head: Head, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """The head number of each token (-1: none) and its class."""
    number = head.find(tokens.h1)
    return number, np.where(number >= 0, number // SLOTS, open_class(tokens.ending))


def log10_parts(model: Model, tokens: Tokens) -> np.ndarray:
    """For each token log10 of its class's probability, for head words times that of the word in its class."""
    number, kind = parts(model.head, tokens)
    out = np.empty(len(number))
    features = context(tokens)
    for at in range(0, len(number), BATCH):
        part = slice(at, at + BATCH)
        made = _softmax(model.tables[0], _rows(features[:, part]), model.class_bias)
        logs = np.log10(made[np.arange(len(made)), kind[part]].astype(np.float64))
        inner = np.nonzero(number[part] >= 0)[0]
        if len(inner):
            of = kind[part][inner]
            slot = number[part][inner] % SLOTS
            within = _softmax(model.tables[1], _rows(features[:, part][:, inner], of), model.slot_bias[of])
            logs[inner] += np.log10(within[np.arange(len(inner)), slot].astype(np.float64))
        out[part] = logs
    return out


def _step(table: np.ndarray, moved: np.ndarray, rows: np.ndarray, gradient: np.ndarray, touched: np.ndarray) -> None:
    """Move the rows of all features against their summed gradients, each at the pace that its history allows."""
    flat = rows.reshape(-1).astype(np.uint16)
    order = np.argsort(flat, kind="stable")  # radix sort
    held = flat[order]
    new = np.append(True, held[1:] != held[:-1])
    which = held[new].astype(np.int64)
    group = np.empty(len(held), np.int64)
    group[order] = np.cumsum(new) - 1
    sums = np.empty((gradient.shape[1], len(which)), np.float32)
    for into, column in zip(sums, gradient.T.astype(np.float64, order="C"), strict=True):
        into[:] = np.bincount(group, np.tile(column, len(rows)), len(which))
    sums = sums.T.copy()
    moved[which] += np.einsum("ij,ij->i", sums, sums)
    sums *= (RATE / np.sqrt(moved[which]))[:, None]
    table[which] -= sums
    touched[which] += 1


def learn(model: Model, tokens: Tokens, touched: list[np.ndarray]) -> None:
    """One pass of gradient steps over the tokens; ``touched`` counts the steps that moved each row."""
    number, kind = parts(model.head, tokens)
    features = context(tokens)
    for at in range(0, len(number), BATCH):
        part = slice(at, at + BATCH)
        rows = _rows(features[:, part])
        made = _softmax(model.tables[0], rows, model.class_bias)
        made[np.arange(len(made)), kind[part]] -= 1
        _step(model.tables[0], model.moved[0], rows, made, touched[0])
        inner = np.nonzero(number[part] >= 0)[0]
        if len(inner):
            of = kind[part][inner]
            rows = _rows(features[:, part][:, inner], of)
            made = _softmax(model.tables[1], rows, model.slot_bias[of])
            made[np.arange(len(inner)), number[part][inner] % SLOTS] -= 1
            _step(model.tables[1], model.moved[1], rows, made, touched[1])


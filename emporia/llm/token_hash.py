"""Tokens of many texts at once: places and 128-bit hashes of all words of an Arrow column, without a loop over words."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes that are hashed at once; a block ends at white space or with its text.
BLOCK = 1 << 16
#: Longer words are hashed by BLAKE2, the others by two polynomials over their bytes.
LONGEST = 64
#: The hash of the token that ends each text; no word is hashed to an end of its own.
END = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_draw = np.random.default_rng(20240229)
_VALUES = _draw.integers(0, 2**64, (2, 256), np.uint64)
_BASES = [0xD1342543DE82EF95, 0xA0761D6478BD642F]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Tables:
    """Powers of both bases and of their inverses, made once per process that hashes."""

    held: list[tuple[np.ndarray, np.ndarray]] = []

    @classmethod
    def get(cls) -> list[tuple[np.ndarray, np.ndarray]]:
        if not cls.held:
            cls.held = [(_powers(b, BLOCK), _powers(pow(b, -1, 2**64), BLOCK)) for b in _BASES]
        return cls.held


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit number spread over all others."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@dataclass
class Tokens:
    """Tokens of some texts in order: two hashes, the last two bytes, and where each text's tokens begin and end.

    Each text ends with one end token, whose ending is 0.
    """

    h1: np.ndarray
    h2: np.ndarray
    ending: np.ndarray
    bounds: np.ndarray


def _hash_block(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: int = 2) -> list[np.ndarray]:
    out = []
    for values, (power, inverse) in list(zip(_VALUES, _Tables.get(), strict=True))[:hashes]:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * power[: len(data)], out=sums[1:])
        out.append(mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)))
    for i in np.nonzero(ends - starts > LONGEST)[0]:
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=16).digest()
        for held, value in zip(out, np.frombuffer(digest, np.uint64), strict=False):
            held[i] = value
    return out


def _hash_word(word: np.ndarray, hashes: int) -> list[int]:
    if len(word) <= BLOCK:
        return [int(x[0]) for x in _hash_block(word, np.array([0]), np.array([len(word)]), hashes)]
    return np.frombuffer(hashlib.blake2b(word.tobytes(), digest_size=16).digest(), np.uint64)[:hashes].tolist()


def _endings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    last = data[ends - 1].astype(np.int32)
    before = np.where(ends - starts > 1, data[np.maximum(ends - 2, 0)], 0)
    return last * 256 + before


def _places(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; ``breaks`` are places where a new text begins."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    starts = inside[1:] & ~inside[:-1]
    ends = ~inside[1:] & inside[:-1]
    cut = breaks[(breaks > 0) & (breaks < len(data))]
    cut = cut[inside[cut] & inside[cut + 1]]
    starts[cut] = ends[cut] = True
    return np.nonzero(starts)[0], np.nonzero(ends)[0]


def _block_end(data: np.ndarray, at: int) -> int:
    """The end of the block at ``at``: the last white space in reach, or else the end of the word that fills it."""
    stop = min(at + BLOCK, len(data))
    if stop == len(data):
        return stop
    spaces = np.nonzero(_SPACE[data[at:stop]])[0]
    if len(spaces):
        return at + int(spaces[-1]) + 1
    while stop < len(data):
        spaces = np.nonzero(_SPACE[data[stop : stop + BLOCK]])[0]
        if len(spaces):
            return stop + int(spaces[0])
        stop = min(stop + BLOCK, len(data))
    return stop


def tokens(texts: pa.Array, hashes: int = 2) -> Tokens:
    """Words (runs other than ASCII white space, A-Z lower-cased) of a string column and an end token after each text.

    With one of the ``hashes`` only, ``h2`` repeats ``h1``. Null texts are empty. Room beside the text and the result is bounded by the block, but for a word longer than that.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    breaks = offsets - offsets[0]
    h1, h2, ending, where = [], [], [], []
    at = 0
    while at < len(data):
        stop = _block_end(data, at)
        block = _LOWER[data[at:stop]]
        inner = breaks[np.searchsorted(breaks, at) : np.searchsorted(breaks, stop)] - at
        starts, ends = _places(block, inner)
        if len(block) <= BLOCK:
            made = _hash_block(block, starts, ends, hashes)
        else:  # no white space, so its words are single ones, perhaps of several texts
            each = [_hash_word(block[a:b], hashes) for a, b in zip(starts, ends, strict=True)]
            made = list(np.array(each, np.uint64).reshape(-1, hashes).T)
        h1.append(made[0])
        h2.append(made[-1])
        ending.append(_endings(block, starts, ends))
        where.append(starts + at)
        at = stop
    empty = np.zeros(0, np.uint64)
    h1, h2 = np.concatenate([empty, *h1]), np.concatenate([empty, *h2])
    ending, where = np.concatenate([np.zeros(0, np.int32), *ending]), np.concatenate([np.zeros(0, np.int64), *where])
    last = np.searchsorted(where, breaks[1:])  # words that begin before each text's end
    return Tokens(
        np.insert(h1, last, np.uint64(END[0])), np.insert(h2, last, np.uint64(END[1])), np.insert(ending, last, 0),
        np.concatenate([[0], last + np.arange(1, len(texts) + 1)]),
    )

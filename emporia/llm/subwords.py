"""Character n-grams of many words at once, as 64-bit hashes."""

from __future__ import annotations

import numpy as np

_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
MARK = " "


def gram_hashes(words: list[str], sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The number of the word and the hash of every n-gram; words stand between marks, which are no 1-gram."""
    joined = "".join([f"{MARK}{w}{MARK}" for w in words])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.repeat(np.cumsum(lengths), lengths)
    word = np.repeat(np.arange(len(words)), lengths)
    owners, hashes = [], []
    for size in sizes:
        count = len(codes) - size + 1
        if count <= 0:
            continue
        held = np.full(count, size, np.uint64)
        for i in range(size):
            held = held * _STEP + codes[i : i + count]
        inside = np.arange(count) + size <= ends[:count]
        if size == 1:
            inside &= codes != ord(MARK)
        held = held[inside]
        held ^= held >> np.uint64(29)
        held *= _MIX
        held ^= held >> np.uint64(32)
        owners.append(word[:count][inside])
        hashes.append(held)
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(owners), np.concatenate(hashes)


class WordTable(dict):
    """Numbers for words as they are met; ``fresh`` holds those that have no row in ``table`` yet."""

    def __init__(self, width: int, limit: int) -> None:
        super().__init__()
        self.limit = limit
        self.fresh: list[str] = []
        self.table = np.zeros((1024, width))

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        self.fresh.append(word)
        return at

    def numbers(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def fill(self, rows_of) -> None:
        """Compute the rows of the fresh words with ``rows_of`` (words -> rows)."""
        begin = len(self) - len(self.fresh)
        if len(self) > len(self.table):
            grown = np.zeros((2 * len(self), self.table.shape[1]))
            grown[:begin] = self.table[:begin]
            self.table = grown
        for at in range(0, len(self.fresh), 20_000):
            part = self.fresh[at : at + 20_000]
            self.table[begin + at : begin + at + len(part)] = rows_of(part)
        self.fresh = []

    def trim(self) -> None:
        """Start anew when too many words are held."""
        if len(self) > self.limit:
            self.clear()

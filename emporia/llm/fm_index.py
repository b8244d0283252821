"""An FM-index over the words of a shard: suffix order, wavelet-matrix ranks and sampled positions, in numpy."""

from __future__ import annotations

import numpy as np

#: Every how many words of a run the position is kept.
SAMPLE = 8


def suffix_order(codes: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes; zeros are separators, each smaller than those after it and all words.

    Prefix doubling that sorts only what is still tied. A separator ends every comparison, so ties last as long as
    the longest repeated run of words.
    """
    n = len(codes)
    gaps = np.nonzero(codes == 0)[0]
    words = np.nonzero(codes)[0]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[gaps] = np.arange(len(gaps))
    order = np.empty(n, np.int64)
    order[: len(gaps)] = gaps
    by_word = words[np.argsort(codes[words], kind="stable")]
    order[len(gaps) :] = by_word
    at, width = np.arange(len(gaps), n), 1
    fresh = np.ones(len(by_word), bool)
    fresh[1:] = codes[by_word[1:]] != codes[by_word[:-1]]
    while len(at):
        held = order[at]
        # the rank of a tied suffix is the place where its group begins
        rank[held] = np.maximum.accumulate(np.where(fresh, at, 0))
        tied = ~(fresh & np.append(fresh[1:], True))
        at, held = at[tied], held[tied]
        if not len(at):
            break
        own, ahead = rank[held], rank[np.minimum(held + width, n)]
        turn = np.argsort(own * (n + 1) + ahead, kind="stable")
        order[at] = held[turn]
        own, ahead = own[turn], ahead[turn]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (own[1:] != own[:-1]) | (ahead[1:] != ahead[:-1])
        width *= 2
    return order


class Wavelet:
    """Counts of any symbol before any place of a sequence, for many questions at once."""

    def __init__(self, codes: np.ndarray, symbols: int) -> None:
        self.depth = max(1, int(symbols - 1).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        held = codes
        for level in reversed(range(self.depth)):
            bit = (held >> level) & 1
            ones = np.zeros(len(held) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(held) - int(ones[-1]))
            held = np.concatenate([held[bit == 0], held[bit == 1]])

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        begin, end = np.zeros(len(places), np.int64), places.astype(np.int64)
        for level, ones, zeros in zip(reversed(range(self.depth)), self.ones, self.zeros, strict=True):
            one = ((symbols >> level) & 1).astype(bool)
            before_begin, before_end = ones[begin], ones[end]
            begin = np.where(one, zeros + before_begin, begin - before_begin)
            end = np.where(one, zeros + before_end, end - before_end)
        return end - begin


class FmIndex:
    """Index of ``codes``: words from 1 to ``symbols - 1``, zeros between runs of words."""

    def __init__(self, codes: np.ndarray, symbols: int) -> None:
        order = suffix_order(codes)
        before = np.where(order > 0, codes[order - 1], 0)
        self.before = before
        self.wavelet = Wavelet(before, symbols)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=symbols))])
        sampled = (order % SAMPLE == 0) | (before == 0)
        self.kept = np.cumsum(sampled) - sampled
        self.sampled, self.positions = sampled, order[sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that begin with each phrase; phrases are rows, filled up with zeros at the end."""
        begin, end = np.zeros(len(phrases), np.int64), np.full(len(phrases), len(self.before), np.int64)
        for column in reversed(range(phrases.shape[1])):
            live = np.nonzero((lengths > column) & (begin < end))[0]
            word = phrases[live, column]
            begin[live] = self.first[word] + self.wavelet.rank(word, begin[live])
            end[live] = self.first[word] + self.wavelet.rank(word, end[live])
        return begin, np.maximum(begin, end)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes, found by walking back to the nearest sampled one."""
        rows, out, steps = rows.copy(), np.zeros(len(rows), np.int64), 0
        left = np.arange(len(rows))
        while len(left):
            done = self.sampled[rows[left]]
            out[left[done]] = self.positions[self.kept[rows[left[done]]]] + steps
            left = left[~done]
            word = self.before[rows[left]]
            rows[left] = self.first[word] + self.wavelet.rank(word, rows[left])
            steps += 1
        return out

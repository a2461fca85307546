"""Suffix arrays over words, of many texts at once, for the repetition and run operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from .common import WORD

BLOCK_WORDS = 200_000       # texts are taken together up to this many words (a longer text goes alone)


def blocks(texts: Iterable[tuple[object, str]], words: int = BLOCK_WORDS) -> Iterator[list[tuple[object, str, list[str]]]]:
    """(row, text, words) of (row, text) pairs, in lists of about ``words`` words, every text whole."""
    held, n = [], 0
    for row, text in texts:
        w = WORD.findall(text)
        if held and n + len(w) > words:
            yield held
            held, n = [], 0
        held.append((row, text, w))
        n += len(w)
    if held:
        yield held


def numbered(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Equal words get equal numbers; and where each text starts (one more for the end)."""
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    words = pa.array([w for t in texts for w in t], pa.large_string())
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64), bounds


class Suffixes:
    """Suffix array by prefix doubling; suffixes of different texts are never equal.

    ``array`` holds the positions in suffix order. ``levels[k]`` gives for every position
    the first slot of the suffixes that agree with it on 2^k words: two positions with
    the same entry start equal runs of that many words, inside their texts. Levels end
    where no two positions agree, and each round sorts only the positions that still
    agree with another, so memory is 4 bytes a word and level.
    """

    def __init__(self, symbols: np.ndarray, bounds: np.ndarray):
        n = len(symbols)
        self.n, self.symbols = n, symbols
        sizes = np.diff(bounds)
        self.text = np.repeat(np.arange(len(sizes)), sizes)
        self.start, self.end = np.repeat(bounds[:-1], sizes), np.repeat(bounds[1:], sizes)
        self.levels: list[np.ndarray] = []
        key = self.text * (int(symbols.max(initial=0)) + 1) + symbols
        self.array = np.argsort(key, kind="stable")
        slots = np.arange(n)
        rank = np.zeros(n, np.int32)
        at, keys, h = self.array, key[self.array], 1
        while len(slots):
            first = np.ones(len(slots), bool)
            first[1:] = keys[1:] != keys[:-1]
            lead = np.maximum.accumulate(np.where(first, slots, 0))
            rank[at] = lead
            alone = first & np.append(first[1:], True)
            slots = slots[~alone]
            if not len(slots):
                break
            self.levels.append(rank.copy())
            at = at[~alone]
            after = at + h
            inside = after < self.end[at]
            keys = rank[at].astype(np.int64) * (n + 1) + np.where(inside, rank[np.minimum(after, n - 1)] + 1, 0)
            order = np.argsort(keys, kind="stable")
            at, keys = at[order], keys[order]
            self.array[slots] = at
            h *= 2

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on (i < j or j < i, of one text)."""
        far, both = np.minimum(self.end[i] - i, self.end[j] - j), np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.levels))):
            rank = self.levels[k]
            more = both < far
            same = rank[np.minimum(i + both, self.n - 1)] == rank[np.minimum(j + both, self.n - 1)]
            both += np.where(more & same, 1 << k, 0)
        return both

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words right before i equal those right before j (i < j, of one text)."""
        far, both = i - self.start[i], np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.levels))):
            rank, h = self.levels[k], 1 << k
            more = both + h <= far
            same = rank[np.maximum(i - both - h, 0)] == rank[np.maximum(j - both - h, 0)]
            both += np.where(more & same, h, 0)
        return both

    def common(self, least: int) -> np.ndarray:
        """By slot: the longest common prefix with the slot before, 0 where under ``least``."""
        out = np.zeros(self.n, np.int64)
        k = least.bit_length() - 1
        if k < len(self.levels):
            rank = self.levels[k][self.array]
            slots = np.flatnonzero(rank[1:] == rank[:-1]) + 1
            both = self.ahead(self.array[slots - 1], self.array[slots])
            out[slots] = np.where(both >= least, both, 0)
        return out


def covered(start: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in a span [start, start + length)."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, start, 1)
    np.add.at(step, start + length, -1)
    return np.cumsum(step[:n]) > 0


class Wavelet:
    """Wavelet matrix over whole numbers: order statistics of any slice, for many slices at once."""

    def __init__(self, values: np.ndarray):
        self.planes: list[tuple[int, np.ndarray]] = []      # bit, zeros before each place
        for bit in reversed(range(max(int(values.max(initial=0)).bit_length(), 1))):
            one = (values >> bit & 1).astype(bool)
            zeros = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~one, out=zeros[1:])
            self.planes.append((bit, zeros))
            values = np.concatenate([values[~one], values[one]])

    def _descend(self, lo, hi, zeros, one):
        z = int(zeros[-1])
        l0, h0 = zeros[lo], zeros[hi]
        return np.where(one, z + lo - l0, l0), np.where(one, z + hi - h0, h0)

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many of the values in [lo, hi) are less than x (x within the values' bits)."""
        count = np.zeros(len(lo), np.int64)
        for bit, zeros in self.planes:
            one = (x >> bit & 1).astype(bool)
            count += np.where(one, zeros[hi] - zeros[lo], 0)
            lo, hi = self._descend(lo, hi, zeros, one)
        return count

    def nth(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value with k smaller ones (by order) in [lo, hi); k < hi - lo."""
        value = np.zeros(len(lo), np.int64)
        for bit, zeros in self.planes:
            low = zeros[hi] - zeros[lo]
            one = k >= low
            k = np.where(one, k - low, k)
            value |= one.astype(np.int64) << bit
            lo, hi = self._descend(lo, hi, zeros, one)
        return value

    def successor(self, lo: np.ndarray, hi: np.ndarray, after: np.ndarray) -> np.ndarray:
        """The least value greater than ``after``, a value of [lo, hi) itself; -1 if there is none."""
        upto = self.below(lo, hi, after) + 1
        there = upto < hi - lo
        out = np.full(len(lo), -1, np.int64)
        out[there] = self.nth(lo[there], hi[there], upto[there])
        return out

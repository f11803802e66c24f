"""Elias-Fano n-gram trie levels in memory-mapped files."""

from __future__ import annotations

import tempfile

import numpy as np


def mapped(a: np.ndarray) -> np.ndarray:
    """The array as a read-only map of an unnamed file, which goes with the task."""
    with tempfile.TemporaryFile() as f:
        f.write(a.tobytes())
        f.flush()
        return np.memmap(f, a.dtype, "r", shape=a.shape) if a.size else a


_bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
#: For each value of a bit, how often a byte has it, and the place in a byte where it has it for the k-th time.
_count = np.stack([8 - _bits.sum(1), _bits.sum(1)]).astype(np.int64)
_place = np.stack([np.argsort(_bits != one, axis=1, kind="stable") for one in (0, 1)]).astype(np.int64)


class EliasFano:
    """A non-decreasing sequence of numbers below 2 ** 63: low bits in fixed width, high bits in unary. Sampled positions (how
    many zeros stand before each word of 64 bits) find the k-th zero or one of the unary bits without reading the others."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.top = int(values[-1]) if self.n else 0
        self.width = min(48, max(0, (self.top // max(self.n, 1)).bit_length() - 1)) if self.n else 0
        low = values & np.uint64((1 << self.width) - 1)
        shifts = np.arange(self.width, dtype=np.uint64)
        bits = np.concatenate([((low[i : i + 65536, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel() for i in range(0, self.n, 65536)] or [np.zeros(0, np.uint8)])
        packed = np.packbits(bits, bitorder="little")
        self.low = mapped(np.append(packed, np.zeros(16 + -len(packed) % 8, np.uint8)).view(np.uint64))
        self.bits = self.n + (self.top >> self.width) + 1
        unary = np.zeros(self.bits + -self.bits % 64, np.uint8)
        unary[(values >> np.uint64(self.width)).astype(np.int64) + np.arange(self.n)] = 1
        self.high = mapped(np.packbits(unary, bitorder="little"))
        ones = unary.reshape(-1, 64).sum(1, dtype=np.int64)
        self.before = [np.cumsum(c) - c for c in (64 - ones, ones)]

    def nbytes(self) -> int:
        return self.low.nbytes + self.high.nbytes

    def select(self, k: np.ndarray, one: int) -> np.ndarray:
        """The places of the k-th zeros, or ones, of the unary bits, from 0."""
        word = np.searchsorted(self.before[one], k, side="right") - 1
        left = k - self.before[one][word]
        part = self.high.reshape(-1, 8)[word]
        seen = np.cumsum(_count[one][part], axis=1)
        byte = (seen <= left[:, None]).sum(1)
        rows = np.arange(len(k))
        left = left - np.where(byte > 0, seen[rows, byte - 1], 0)
        return word * 64 + byte * 8 + _place[one][part[rows, byte], left]

    def lows(self, i: np.ndarray) -> np.ndarray:
        at = i.astype(np.uint64) * np.uint64(self.width)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        above = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return ((self.low[word] >> shift) | above) & np.uint64((1 << self.width) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The i-th numbers."""
        return ((self.select(i, 1) - i).astype(np.uint64) << np.uint64(self.width)) | self.lows(i)

    def starts(self, high: np.ndarray) -> np.ndarray:
        """How many numbers have smaller high bits than these."""
        most = (self.top >> self.width) + 1
        h = np.clip(high, 1, most)
        return np.where(high <= 0, 0, np.where(high >= most, self.n, self.select(h - 1, 0) - (h - 1)))


class Level:
    """Successors of contexts: a context's sorted ids follow each other, pointers say where each context begins. Ids are those
    of their context alone; stored is each on top of the last one before its context, so that the whole is in order."""

    def __init__(self, context: np.ndarray, successor: np.ndarray, codes: np.ndarray, contexts: int):
        """context: ranks from 0, ascending; successor: ids, ascending within a context."""
        begin = np.searchsorted(context, np.arange(contexts + 1))
        self.pointers = EliasFano(begin.astype(np.uint64))
        most = np.where(np.diff(begin) > 0, successor[np.maximum(begin[1:] - 1, 0)] if len(successor) else 0, 0).astype(np.uint64)
        self.ids = EliasFano(successor.astype(np.uint64) + (np.cumsum(most) - most)[context] if len(context) else np.zeros(0, np.uint64))
        self.codes = mapped(codes)

    def find(self, context: np.ndarray, successor: np.ndarray, step: int = 1 << 18) -> np.ndarray:
        """The place of each (context, successor), or -1."""
        if not self.ids.n or not len(context):
            return np.full(len(context), -1)
        return np.concatenate([self._find(context[k : k + step], successor[k : k + step]) for k in range(0, len(context), step)])

    def _find(self, context: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """The search for the next id not below it reads the pointers of its context and stays between them."""
        kinds, of = np.unique(context, return_inverse=True)
        begin, stop = (self.pointers.get(kinds + k).astype(np.int64) for k in (0, 1))
        base = np.where(begin > 0, self.ids.get(np.maximum(begin - 1, 0)), np.uint64(0))
        begin, stop, key = begin[of], stop[of], base[of] + successor.astype(np.uint64)
        high = (key >> np.uint64(self.ids.width)).astype(np.int64)
        at, end = np.maximum(self.ids.starts(high), begin), np.minimum(self.ids.starts(high + 1), stop)
        low = key & np.uint64((1 << self.ids.width) - 1)
        stop, todo = end.copy(), np.flatnonzero(at < end)
        while len(todo):  # ids with the same high bits are in order of their low bits
            middle = (at[todo] + stop[todo]) >> 1
            below = self.ids.lows(middle) < low[todo]
            at[todo[below]] = middle[below] + 1
            stop[todo[~below]] = middle[~below]
            todo = todo[at[todo] < stop[todo]]
        out, todo = np.full(len(key), -1), np.flatnonzero(at < end)
        same = self.ids.lows(at[todo]) == low[todo]
        out[todo[same]] = at[todo[same]]
        return out

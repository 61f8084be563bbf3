"""Minimal perfect hash of 128-bit keys: a cascade of bit arrays.

Level by level each key that still has no place is hashed into a bit array of
``GAMMA`` bits per key; a key alone on its bit is placed there, the others go
to the next level. The rank of a key's bit among all set bits is its index, so
n keys have the indices 0 to n-1 in about three bits each.
"""

from __future__ import annotations

import io

import numpy as np

from vigil.llm.common import seeded64

GAMMA = 2.0


class PerfectHash:
    def __init__(self, words: list[np.ndarray], sizes: list[int]):
        self.words, self.sizes = words, sizes
        self.before, total = [], 0
        for w in words:
            ones = np.bitwise_count(w).astype(np.int64)
            self.before.append(total + np.concatenate([[0], np.cumsum(ones)[:-1]]))
            total += int(ones.sum())
        self.n = total

    @staticmethod
    def _place(h1, h2, level, size):
        return (seeded64(h1 ^ seeded64(h2, 2 * level + 1), 2 * level) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> "PerfectHash":
        """``h1``, ``h2``: the two halves of distinct keys."""
        words, sizes, level = [], [], 0
        while len(h1):
            size = (int(len(h1) * GAMMA) // 64 + 1) * 64
            at = cls._place(h1, h2, level, size)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            rest = ~alone[at]
            h1, h2, level = h1[rest], h2[rest], level + 1
        return cls(words, sizes)

    def index(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Index of each key; a key that was not built in gets any index or -1."""
        out = np.full(len(h1), -1, np.int64)
        todo = np.arange(len(h1))
        for level, (w, size, before) in enumerate(zip(self.words, self.sizes, self.before, strict=True)):
            if not len(todo):
                break
            at = self._place(h1[todo], h2[todo], level, size)
            word, bit = w[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[todo[hit]] = (before[at >> 6] + below)[hit]
            todo = todo[~hit]
        return out


class LineIndex:
    """A perfect hash with, per key, a 64-bit fingerprint, the number of
    documents and the document that keeps the line (``has_keep`` false: none)."""

    def __init__(self, mph: PerfectHash, fingerprint, count, keep, has_keep):
        self.mph, self.fingerprint, self.count, self.keep, self.has_keep = mph, fingerprint, count, keep, has_keep

    @classmethod
    def build(cls, keys: np.ndarray, count: np.ndarray, keep: np.ndarray, has_keep: np.ndarray) -> "LineIndex":
        h = np.ascontiguousarray(keys).view(np.uint64).reshape(-1, 2)
        mph = PerfectHash.build(h[:, 0], h[:, 1])
        at = mph.index(h[:, 0], h[:, 1])
        arrays = [np.empty(len(h), x.dtype) for x in (h, count, keep, has_keep)]
        for a, x in zip(arrays, (h[:, 1], count, keep, has_keep), strict=True):
            a[at] = x
        return cls(mph, *arrays)

    def drops(self, keys: np.ndarray, ids: np.ndarray, has_id: np.ndarray) -> np.ndarray:
        """Which (key, document) loses its line."""
        h = np.ascontiguousarray(keys).view(np.uint64).reshape(-1, 2)
        at = self.mph.index(h[:, 0], h[:, 1])
        out = np.zeros(len(h), bool)
        some = np.flatnonzero(at >= 0)
        at = at[some]
        hit = self.fingerprint[at] == h[some, 1]
        out[some] = hit & self.has_keep[at] & (~has_id[some] | (ids[some] != self.keep[at]))
        return out

    def dumps(self) -> bytes:
        to = io.BytesIO()
        np.savez(to, sizes=np.array(self.mph.sizes, np.int64), fingerprint=self.fingerprint, count=self.count,
                 keep=self.keep, has_keep=self.has_keep, **{f"w{i}": w for i, w in enumerate(self.mph.words)})
        return to.getvalue()

    @classmethod
    def loads(cls, blob: bytes) -> "LineIndex":
        z = np.load(io.BytesIO(blob))
        sizes = [int(x) for x in z["sizes"]]
        mph = PerfectHash([z[f"w{i}"] for i in range(len(sizes))], sizes)
        return cls(mph, z["fingerprint"], z["count"], z["keep"], z["has_keep"])

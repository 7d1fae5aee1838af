"""Encoding by distinct units: each worker encodes a unit once and copies its ids wherever the unit returns."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from . import kernels as K


class UnitMemo:
    """Ids of units by 64-bit key, with a second, independent fingerprint that every hit has to meet too.

    `encode` gets distinct units and returns their ids one after another with the count of each; a unit whose key is that of
    another unit is encoded by itself. At `limit` units the memo starts afresh. `kind`: of the ids, wide enough for the vocabulary.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], kind: type = np.uint16, limit: int = 1_500_000):
        self.encode, self.kind, self.limit = encode, kind, limit
        self.clear()

    def clear(self) -> None:
        self.keys, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.check, self.start, self.length = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.flat, self.used = np.zeros(1 << 16, self.kind), 0

    def ids(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All units' ids one after another, and how many each unit has."""
        if not len(start):
            return self.flat[:0], np.zeros(0, np.int64)
        at8 = K.wide(buf)
        check = K.strings(at8, buf, start, end, seed=0x2545F4914F6CDD1D)
        keys, first, back = np.unique(K.strings(at8, buf, start, end), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.limit:
            self.clear()
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        new = np.flatnonzero(~known)
        if len(new):
            self.add(keys[new], at[new], check[first[new]], *self.encode(units(buf, start[first[new]], end[first[new]])))
            at = np.searchsorted(self.keys, keys)
        slot = self.slot[at][back]
        length = self.length[slot].astype(np.int64)
        found = K.gather(self.flat, self.start[slot], length)
        other = np.flatnonzero(self.check[slot] != check)
        if len(other):
            found, length = self.mended(found, length, other, *self.encode(units(buf, start[other], end[other])))
        return found, length

    def add(self, keys: np.ndarray, at: np.ndarray, check: np.ndarray, ids: np.ndarray, length: np.ndarray) -> None:
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(max(len(ids), len(self.flat)), self.kind)])
        self.flat[self.used : self.used + len(ids)] = ids
        start = self.used + np.cumsum(length) - length
        self.used += len(ids)
        self.slot = np.insert(self.slot, at, np.arange(len(self.start), len(self.start) + len(keys)))
        self.keys = np.insert(self.keys, at, keys)
        self.check, self.start, self.length = np.concatenate([self.check, check]), np.concatenate([self.start, start]), np.concatenate([self.length, length.astype(np.int32)])

    def mended(self, found: np.ndarray, length: np.ndarray, other: np.ndarray, ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """found with the units `other` replaced by their own ids."""
        at, own = np.cumsum(length) - length, np.cumsum(count) - count
        parts = [found[a : a + n] for a, n in zip(at.tolist(), length.tolist(), strict=True)]
        for k, a, n in zip(other.tolist(), own.tolist(), count.tolist(), strict=True):
            parts[k] = ids[a : a + n]
        length = length.copy()
        length[other] = count
        return np.concatenate(parts), length


def units(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[bytes]:
    raw = buf.tobytes()
    return [raw[s:e] for s, e in zip(start.tolist(), end.tolist(), strict=True)]

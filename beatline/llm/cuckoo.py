"""A cuckoo filter over 16-byte keys whose state is one byte string."""

from __future__ import annotations

import struct

import numpy as np

SLOTS, KICKS = 4, 500
_HEADER = struct.Struct("<QQ")  # buckets, seed of the eviction order


class Full(Exception):
    """No room for another key; build the filter anew with more buckets."""


class CuckooFilter:
    """Approximate set with deletion: no false negatives while only members are removed.

    Buckets have four slots of 16-bit fingerprints, 0 for a free slot. A key's
    second bucket depends on its first and its fingerprint alone.
    """

    def __init__(self, keys: int = 0, state: bytes | None = None):
        if state is None:
            buckets = 1 << max(1, int(np.ceil(np.log2(max(keys, 1) / SLOTS / 0.85 + 1))))
            self.seed, self.cells = 1, np.zeros((buckets, SLOTS), np.uint16)
        else:
            buckets, self.seed = _HEADER.unpack_from(state)
            self.cells = np.frombuffer(state, np.uint16, offset=_HEADER.size).reshape(buckets, SLOTS).copy()

    def state(self) -> bytes:
        return _HEADER.pack(len(self.cells), self.seed) + self.cells.tobytes()

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints and both buckets of an (n, 2) array of 64-bit key halves."""
        mask = np.uint64(len(self.cells) - 1)
        prints = (keys[:, 1] >> np.uint64(48)) | np.uint64(1)
        first = keys[:, 0] & mask
        return prints.astype(np.uint16), first.astype(np.int64), self._other(first, prints).astype(np.int64)

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        mask = np.uint64(len(self.cells) - 1)
        with np.errstate(over="ignore"):
            mixed = prints.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (bucket.astype(np.uint64) ^ (mixed >> np.uint64(24))) & mask

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, one, two = self.places(keys)
        want = prints[:, None]
        return (self.cells[one] == want).any(axis=1) | (self.cells[two] == want).any(axis=1)

    def add(self, keys: np.ndarray) -> None:
        for fp, one, two in zip(*self.places(keys), strict=True):
            if not (self._put(one, fp) or self._put(two, fp)):
                self._evict(one, fp)

    def _put(self, bucket: int, fp: int) -> bool:
        row = self.cells[bucket]
        for i in range(SLOTS):
            if not row[i]:
                row[i] = fp
                return True
        return False

    def _evict(self, bucket: int, fp: int) -> None:
        for _ in range(KICKS):
            self.seed = (self.seed * 6364136223846793005 + 1442695040888963407) % 2**64
            slot = (self.seed >> 33) % SLOTS
            fp, self.cells[bucket, slot] = self.cells[bucket, slot], fp
            bucket = int(self._other(np.array([bucket]), np.array([fp]))[0])
            if self._put(bucket, fp):
                return
        raise Full

    def remove(self, keys: np.ndarray) -> None:
        """Take out one copy of each key; every key must have been added."""
        for fp, one, two in zip(*self.places(keys), strict=True):
            for bucket in (one, two):
                at = np.flatnonzero(self.cells[bucket] == fp)
                if len(at):
                    self.cells[bucket, at[0]] = 0
                    break


def halves(keys: list[bytes]) -> np.ndarray:
    """16-byte keys as an (n, 2) array of unsigned 64-bit halves."""
    return np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)

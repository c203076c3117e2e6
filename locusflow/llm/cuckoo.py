"""Cuckoo filters: approximate sets of 64-bit digests that can lose members again."""

from __future__ import annotations

import numpy as np

from locusflow.llm.words import mix

_U = np.uint64
SLOTS = 4
ROUNDS = 400  # moves after which a filter counts as full


def _first_of_each(at: np.ndarray) -> np.ndarray:
    """True for the first entry of every value."""
    first = np.zeros(len(at), bool)
    first[np.unique(at, return_index=True)[1]] = True
    return first


class Cuckoo:
    """Fingerprints of 16 bits in buckets of four, each in one of two buckets of its digest.

    ``contains`` never misses a member. Members must be inserted once and only members may be deleted, which the exact
    tables behind the filter see to; digests that share a fingerprint have an entry each.
    """

    def __init__(self, buckets: np.ndarray):
        self.buckets = buckets  # (a power of two, SLOTS) of uint16, 0 is free

    @classmethod
    def sized(cls, members: int) -> Cuckoo:
        """A filter that is at most 80 % full with so many members."""
        need = max(2, int(np.ceil(members / (0.8 * SLOTS))))
        return cls(np.zeros((1 << (need - 1).bit_length(), SLOTS), np.uint16))

    @classmethod
    def holding(cls, digests: np.ndarray) -> Cuckoo:
        size = max(1, len(digests))
        while True:
            new = cls.sized(size)
            if new.insert(digests):
                return new
            size *= 2

    @classmethod
    def of_bytes(cls, blob: bytes) -> Cuckoo:
        return cls(np.frombuffer(blob, np.uint16).reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.buckets.tobytes()

    def _places(self, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        d = mix(digests.astype(np.int64, copy=False).view(_U))
        prints = np.maximum(d >> _U(48), _U(1)).astype(np.uint16)
        one = (d & _U(len(self.buckets) - 1)).astype(np.int64)
        return prints, one, self._other(one, prints)

    def _other(self, at: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return at ^ (mix(prints.astype(_U)) & _U(len(self.buckets) - 1)).astype(np.int64)

    def contains(self, digests: np.ndarray) -> np.ndarray:
        prints, one, two = self._places(digests)
        return (self.buckets[one] == prints[:, None]).any(1) | (self.buckets[two] == prints[:, None]).any(1)

    def _fill(self, at: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """Puts entries into free slots of their buckets, one per bucket; tells which found one."""
        free = self.buckets[at] == 0
        goes = _first_of_each(at) & free.any(1)
        self.buckets[at[goes], free[goes].argmax(1)] = prints[goes]
        return goes

    def insert(self, digests: np.ndarray) -> bool:
        """Adds all digests; false if the filter is too full, which leaves it useless."""
        prints, at, two = self._places(digests)
        for _ in range(SLOTS):
            placed = self._fill(at, prints)
            prints, at, two = prints[~placed], at[~placed], two[~placed]
        at = two
        for k in range(ROUNDS):
            if not len(prints):
                return True
            placed = self._fill(at, prints)
            prints, at = prints[~placed], at[~placed]
            # one entry of every full bucket gives way and moves to its other bucket
            full = _first_of_each(at) & (self.buckets[at] != 0).all(1)
            slot = (k + at[full]) % SLOTS
            out = self.buckets[at[full], slot].copy()
            self.buckets[at[full], slot] = prints[full]
            prints[full] = out
            at[full] = self._other(at[full], out)
        return not len(prints)

    def delete(self, digests: np.ndarray) -> None:
        """Takes one entry of each digest away."""
        prints, one, two = self._places(digests)
        while len(prints):
            here, there = (self.buckets[at] == prints[:, None] for at in (one, two))
            at = np.where(here.any(1), one, two)
            held = here | there
            held[here.any(1)] = here[here.any(1)]
            goes = _first_of_each(at) & held.any(1)
            if not goes.any():
                raise ValueError("a digest to delete is no member")
            self.buckets[at[goes], held[goes].argmax(1)] = 0
            prints, one, two = prints[~goes], one[~goes], two[~goes]

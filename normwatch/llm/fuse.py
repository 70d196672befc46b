"""Static binary-fuse filters: membership of 64-bit keys in about nine bits a key, no misses."""

from __future__ import annotations

import numpy as np

_U = np.uint64


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser, so that each seed gives other positions."""
    h = keys + _U(seed)
    h ^= h >> _U(33)
    h *= _U(0xFF51AFD7ED558CCD)
    h ^= h >> _U(33)
    h *= _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def _high(h: np.ndarray, count: int) -> np.ndarray:
    """Maps the upper 32 bits evenly to 0 .. count-1."""
    return ((h >> _U(32)) * _U(count)) >> _U(32)


class FuseFilter:
    """Three slots in neighbouring segments hold a key's 8-bit print as their exclusive or.

    ``keys`` are distinct unsigned 64-bit numbers.  ``contains`` is True for every key of the set
    and for about one other key in 256.
    """

    def __init__(self, seed: int, segment: int, segments: int, slots: np.ndarray):
        self.seed, self.segment, self.segments, self.slots = seed, segment, segments, slots

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        keys = np.unique(np.asarray(keys, dtype=_U))
        n = len(keys)
        if n == 0:
            return cls(0, 1, 1, np.zeros(3, np.uint8))
        segment = 1 << max(2, int(np.floor(np.log(n) / np.log(3.33) + 2.25))) if n > 1 else 4
        room = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
        segments = max(1, -(-int(n * room) // segment) - 2)
        for seed in range(1, 1000):
            made = cls(seed, segment, segments, np.zeros((segments + 2) * segment, np.uint8))
            if made._fill(keys):
                return made
            if seed % 20 == 0:
                segments += segments // 10 + 1
        raise RuntimeError("no seed peels this key set")

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = _mixed(keys, self.seed * 0x9E3779B97F4A7C15 % (1 << 64))
        first = _high(h, self.segments * self.segment).astype(np.int64)
        within = self.segment - 1
        at = np.empty((3, len(keys)), np.int64)
        at[0] = first
        at[1] = (first + self.segment) ^ ((h >> _U(18)).astype(np.int64) & within)
        at[2] = (first + 2 * self.segment) ^ (h.astype(np.int64) & within)
        return at, (h ^ (h >> _U(8))).astype(np.uint8)

    def _fill(self, keys: np.ndarray) -> bool:
        at, prints = self._places(keys)
        size, n = len(self.slots), len(keys)
        number = np.arange(n)
        degree = np.bincount(at.ravel(), minlength=size)
        owner = np.zeros(size, np.int64)
        np.bitwise_xor.at(owner, at.ravel(), np.tile(number, 3))
        peeled: list[tuple[np.ndarray, np.ndarray]] = []
        ready = np.flatnonzero(degree == 1)
        left = n
        while len(ready):
            who, index = np.unique(owner[ready], return_index=True)
            peeled.append((who, ready[index]))
            left -= len(who)
            touched = at[:, who].ravel()
            np.subtract.at(degree, touched, 1)
            np.bitwise_xor.at(owner, touched, np.tile(who, 3))
            touched = np.unique(touched)
            ready = touched[degree[touched] == 1]
        if left:
            return False
        for who, slot in reversed(peeled):
            three = at[:, who]
            self.slots[slot] = 0
            value = prints[who] ^ self.slots[three[0]] ^ self.slots[three[1]] ^ self.slots[three[2]]
            self.slots[slot] = value
        return True

    def contains(self, keys: np.ndarray) -> np.ndarray:
        at, prints = self._places(np.asarray(keys, dtype=_U))
        return prints == self.slots[at[0]] ^ self.slots[at[1]] ^ self.slots[at[2]]

    def to_bytes(self) -> bytes:
        head = np.array([self.seed, self.segment, self.segments], "<i8").tobytes()
        return head + self.slots.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> FuseFilter:
        seed, segment, segments = np.frombuffer(data[:24], "<i8")
        return cls(int(seed), int(segment), int(segments), np.frombuffer(data[24:], np.uint8))

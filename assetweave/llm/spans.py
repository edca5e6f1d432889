"""64-bit hashes of many spans of a byte block at once, and a bounded table from such hashes to places."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_VALUES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Powers:
    """Powers of the hash base and of its inverse, for blocks up to the longest seen."""

    def __init__(self):
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def get(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < size:
            self.up = np.full(size, _BASE, np.uint64)
            self.down = np.full(size, _INVERSE, np.uint64)
            for powers in (self.up, self.down):
                powers[0] = 1
                np.multiply.accumulate(powers, out=powers)
        return self.up, self.down


_powers = Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span data[start:end]: a polynomial in a fixed base over random values of the bytes, mixed."""
    up, down = _powers.get(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * up[:len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class HashTable:
    """Open addressing from 64-bit hashes to numbers; probes and inserts whole arrays."""

    def __init__(self, bits: int = 16):
        self.clear(bits)

    def clear(self, bits: int = 16) -> None:
        self.bits, self.count = bits, 0
        self.keys, self.places = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 if there is none."""
        out = np.full(len(hashes), -1, np.int32)
        slot = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        here, key = self.places[slot], self.keys[slot]
        hit = (key == hashes) & (here >= 0)
        out[hit] = here[hit]
        left = np.flatnonzero(~hit & (here >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            here, key = self.places[slot[left]], self.keys[slot[left]]
            hit = (key == hashes[left]) & (here >= 0)
            out[left[hit]] = here[hit]
            left = left[~hit & (here >= 0)]
        return out

    def add(self, hashes: np.ndarray, places: np.ndarray) -> None:
        """Put in distinct hashes that are not there yet."""
        self.count += len(hashes)
        if self.count * 2 > 1 << self.bits:
            keep = self.places >= 0
            hashes, places = np.concatenate([self.keys[keep], hashes]), np.concatenate([self.places[keep], places])
            self.clear(max(16, int(2 * len(hashes)).bit_length() + 1))
            self.count = len(hashes)
        slot = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        left = np.arange(len(hashes))
        while len(left):
            free = left[self.places[slot[left]] < 0]
            self.places[slot[free]] = places[free]  # of several that want a slot, one gets it
            self.keys[slot[free]] = hashes[free]
            left = left[self.places[slot[left]] != places[left]]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

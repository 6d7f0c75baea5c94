"""A minimal perfect hash over 128-bit keys in numpy, with arrays beside it that the hash indexes.

Level by level, every key left sets the bit at its place in an array of GAMMA bits a key; keys that met another one go
to the next level with another hash. A key's index is the number of set bits before its own, so n keys get 0..n-1 and
need about four bits each. A key that is not a member gets some index, or none, and fails the fingerprint test.
"""

from __future__ import annotations

import numpy as np

from flowloom.llm.shingles import mix

GAMMA = 2.0
_STEP = np.uint64(0xD1B54A32D192ED03)


def _place(h1: np.ndarray, h2: np.ndarray, level: int, bits: int) -> np.ndarray:
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    return (mix(h1 + mix(h2 ^ seed)) % np.uint64(bits)).astype(np.int64)


def fingerprint(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return mix(h2 * _STEP + h1)


def build(h1: np.ndarray, h2: np.ndarray) -> tuple[list[int], bytes, np.ndarray]:
    """Bits of each level, all levels' bits packed, and the index of each (distinct) key."""
    n = len(h1)
    sizes, levels, at_level, at_bit = [], [], np.zeros(n, np.int64), np.zeros(n, np.int64)
    left = np.arange(n)
    offset = 0
    while len(left):
        bits = max(8, int(GAMMA * len(left)) + 7 & ~7)
        place = _place(h1[left], h2[left], len(sizes), bits)
        alone = np.bincount(place, minlength=bits) == 1
        won = alone[place]
        at_bit[left[won]] = offset + place[won]
        sizes.append(bits)
        levels.append(alone)
        offset += bits
        left = left[~won]
    if not levels:
        return [], b"", at_level
    bits_all = np.concatenate(levels)
    rank = np.cumsum(bits_all) - 1
    return sizes, np.packbits(bits_all).tobytes(), rank[at_bit]


class Index:
    """One shard, unpacked for probing: ``find`` gives each key's index, or -1 for keys that surely are no members."""

    def __init__(self, sizes, bits: bytes, fingerprints: bytes, owners: bytes, counts: bytes):
        self.sizes = [int(s) for s in sizes]
        self.bits = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
        self.rank = np.cumsum(self.bits) - 1
        self.fingerprints = np.frombuffer(fingerprints, np.uint64)
        self.owners = np.frombuffer(owners, np.int64)
        self.counts = np.frombuffer(counts, np.uint32)

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        found = np.full(len(h1), -1, np.int64)
        left = np.arange(len(h1))
        offset = 0
        for level, bits in enumerate(self.sizes):
            place = offset + _place(h1[left], h2[left], level, bits)
            hit = self.bits[place]
            found[left[hit]] = self.rank[place[hit]]
            left = left[~hit]
            offset += bits
            if not len(left):
                break
        known = np.flatnonzero(found >= 0)
        wrong = self.fingerprints[found[known]] != fingerprint(h1[known], h2[known])
        found[known[wrong]] = -1
        return found

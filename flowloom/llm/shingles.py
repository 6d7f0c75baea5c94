"""Words and word shingles of many texts at once, as 64-bit hashes in numpy arrays.

A text is lower-cased in A-Z only and cut at ``[\\x20\\x09-\\x0D]``; both act on single bytes of UTF-8, so texts are
handled as bytes. A word's hash is a difference of prefix sums of a polynomial with an odd base modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

WIDTH = 5
CHUNK_BYTES = 1 << 19

_BASE = 0x9E3779B97F4A7C15 | 1
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTE = np.random.default_rng(20240517).integers(1, 2**63, 256, dtype=np.uint64)
_LANES = np.random.default_rng(99).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for at least ``size`` places."""
    if "up" not in _powers or len(_powers["up"]) < size:
        size = max(size, CHUNK_BYTES + (CHUNK_BYTES >> 2))
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            table = np.full(size, np.uint64(base))
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def chunks(texts: Iterable[bytes | None], limit: int = CHUNK_BYTES) -> Iterator[list[bytes]]:
    """Consecutive texts (None as empty) in lists of about ``limit`` bytes; a longer text stands alone."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        text = text or b""
        if held and size + len(text) > limit:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield held


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of the texts in order, and where each text's words begin (one more entry at the end)."""
    data = np.frombuffer(b"\n".join(texts).lower() + b"\n", np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        edge = np.concatenate(([0], edge))
    start, end = edge[0::2], edge[1::2]
    up, down = _power_tables(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=prefix[1:])
    hashes = mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    return hashes, np.searchsorted(start, offsets)


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of each run of ``width`` words; longer by nothing, shorter by ``width - 1`` than its input."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, (int(width) * int(_GOLDEN)) & (2**64 - 1), np.uint64)
    for k in range(width):
        total += hashes[k : n + k] * _LANES[k]
    return mix(total)


def shingle_sets(texts: list[bytes], width: int = WIDTH) -> Iterator[np.ndarray]:
    """Each text's distinct shingles, sorted. Fewer words than ``width`` make one shingle; no word, none."""
    hashes, first = words(texts)
    runs = shingle_hashes(hashes, width)
    for i in range(len(texts)):
        a, b = first[i], first[i + 1]
        if b - a >= width:
            own = runs[a : b - width + 1]
        elif b > a:
            own = shingle_hashes(hashes[a:b], b - a)
        else:
            own = runs[:0]
        yield np.unique(own)


def super_minhash(elements: np.ndarray, owner: np.ndarray, n_sets: int, size: int, block: int = 1 << 15) -> np.ndarray:
    """SuperMinHash signatures of ``n_sets`` sets, as (n_sets, size) words.

    An element visits the places of the signature in an order of its own (a Fisher-Yates shuffle seeded by the
    element) and offers its j-th place the value j + r, r a fraction. Values of step j lie in [j, j+1), so a set whose
    places all hold less than j + 1 has its final signature: its elements stop early.
    """
    if size > 256:
        raise ValueError("a signature has 256 places at most")
    signature = np.full(n_sets * size, np.uint64(2**64 - 1))
    low = np.uint64(0xFFFFFFFF)
    half = np.uint64(32)
    for begin in range(0, len(elements), block):
        state = elements[begin : begin + block].copy()
        base = owner[begin : begin + block].astype(np.int64)
        order = np.tile(np.arange(size, dtype=np.uint8), (len(state), 1))
        row = np.arange(len(state))
        for j in range(size):
            state += _GOLDEN
            z = mix(state)
            k = j + (((z & low) * np.uint64(size - j)) >> half).astype(np.int64)
            place = order[row, k]
            order[row, k] = order[row, j]
            np.minimum.at(signature, base * size + place, (np.uint64(j) << half) | (z >> half))
            own = np.unique(base)
            open_sets = own[signature.reshape(n_sets, size)[own].max(axis=1) >= (np.uint64(j + 1) << half)]
            if not len(open_sets):
                break
            if len(open_sets) < len(own):
                flag = np.zeros(n_sets, bool)
                flag[open_sets] = True
                keep = flag[base]
                state, base, row = state[keep], base[keep], row[keep]
    return signature.reshape(n_sets, size)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key for each band of ``rows`` places; equal keys mean equal places of the same band."""
    n = len(signature)
    cut = signature[:, : bands * rows].reshape(n, bands, rows)
    total = np.tile(np.arange(bands, dtype=np.uint64) * _GOLDEN, (n, 1))
    for k in range(rows):
        total = mix(total + cut[:, :, k] * _LANES[32 + k])
    return total.view(np.int64)

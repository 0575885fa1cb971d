"""Static binary-fuse filters over 64-bit keys, built and probed inside tasks.

Three fingerprints of 8 bits, in three neighbouring segments, are XORed for a key. A key that was built in is always
found, one that wasn't with probability 1/256. A filter takes about 9 to 10 bits a key and can't be changed.
"""

from __future__ import annotations

import struct

import numpy as np

_HEADER = struct.Struct("<QII")  # seed, segment length, segments


def _spread(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys.astype(np.uint64) + np.uint64(seed)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(factor)
    return h ^ (h >> np.uint64(33))


def _places(h: np.ndarray, length: int, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Three slots of each key, in segments that follow one another, and its fingerprint."""
    first = ((h >> np.uint64(32)) * np.uint64(segments - 2) >> np.uint64(32)).astype(np.int64)
    mask = np.uint64(length - 1)
    slots = [(first + k) * length + ((h >> np.uint64(14 * k)) & mask).astype(np.int64) for k in range(3)]
    return *slots, ((h ^ (h >> np.uint64(47))) & np.uint64(0xFF)).astype(np.uint8)


def build(keys: np.ndarray) -> bytes:
    """A filter over the distinct values of ``keys`` (int64 or uint64)."""
    keys = np.unique(keys.astype(np.uint64))
    n = len(keys)
    length = 1 << max(2, min(14, int(np.floor(np.log(max(n, 2)) / np.log(3.33) + 2.25))))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
    for seed in range(1, 200):
        segments = max(3, -(-int(n * factor * (1 + 0.02 * seed) + 1) // length) + 2)
        a, b, c, mark = _places(_spread(keys, seed), length, segments)
        order = _peel(a, b, c, segments * length)
        if order is None:
            continue
        table = bytearray(segments * length)
        abc, marks = np.stack([a, b, c], 1), mark.tolist()
        places = abc.tolist()
        for key, slot in reversed(order):
            x, y, z = places[key]
            table[slot] = marks[key] ^ table[x] ^ table[y] ^ table[z] ^ table[slot]
        return _HEADER.pack(seed, length, segments) + bytes(table)
    raise ValueError("no filter found")


def _peel(a: np.ndarray, b: np.ndarray, c: np.ndarray, size: int) -> list[tuple[int, int]] | None:
    """Keys with the slot that was theirs alone when they were taken out, in that order; None if some stay."""
    n = len(a)
    count = (np.bincount(a, minlength=size) + np.bincount(b, minlength=size) + np.bincount(c, minlength=size)).tolist()
    mixed = np.zeros(size, np.int64)
    for slots in (a, b, c):
        np.bitwise_xor.at(mixed, slots, np.arange(n))
    mixed = mixed.tolist()
    places = np.stack([a, b, c], 1).tolist()
    queue = [i for i, x in enumerate(count) if x == 1]
    order = []
    while queue:
        slot = queue.pop()
        if count[slot] != 1:
            continue
        key = mixed[slot]
        order.append((key, slot))
        for s in places[key]:
            count[s] -= 1
            mixed[s] ^= key
            if count[s] == 1:
                queue.append(s)
    return order if len(order) == n else None


def probe(filter_bytes: bytes, keys: np.ndarray) -> np.ndarray:
    """Whether each key may have been built in."""
    seed, length, segments = _HEADER.unpack_from(filter_bytes)
    table = np.frombuffer(filter_bytes, np.uint8, offset=_HEADER.size)
    a, b, c, mark = _places(_spread(keys, seed), length, segments)
    return (table[a] ^ table[b] ^ table[c]) == mark

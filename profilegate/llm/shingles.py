"""Word shingles of texts as 64-bit hashes, and circulant MinHash signatures of them; runs inside tasks."""

from __future__ import annotations

import functools
import hashlib

import numpy as np

from profilegate.llm.codepoints import mix64

PIECE = 1 << 16
UNIVERSE = 1 << 20  # places of the second permutation
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)


@functools.cache
def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    """By byte: A-Z lowered and 1 added; whether it is no white space."""
    low = np.arange(256, dtype=np.uint64)
    low[ord("A") : ord("Z") + 1] += 32
    word = np.ones(256, bool)
    word[[0x20, *range(0x09, 0x0E)]] = False
    return low + np.uint64(1), word


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@functools.cache
def _base_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(_BASE, PIECE), _powers(_INVERSE, PIECE)


def _hash_words(data: np.ndarray) -> np.ndarray:
    low, word = _byte_tables()
    edge = np.flatnonzero(np.diff(word[data].view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    if not len(edge):
        return np.zeros(0, np.uint64)
    first, end = edge[::2], edge[1::2]
    up, down = _base_powers() if len(data) <= PIECE else (_powers(_BASE, len(data)), _powers(_INVERSE, len(data)))
    upto = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(low[data] * up[: len(data)], out=upto[1:])
    return mix64((upto[end] - upto[first]) * down[first], end - first)


def word_hashes(text: str) -> np.ndarray:
    """A hash of each word, in order; pieces end at white space, so memory follows the longest word."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if len(data) <= PIECE:
        return _hash_words(data)
    word, out, start = _byte_tables()[1], [], 0
    while start < len(data):
        end = min(start + PIECE, len(data))
        while end < len(data) and word[data[end]]:
            end += 1
        out.append(_hash_words(data[start:end]))
        start = end
    return np.concatenate(out)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles; a text with fewer words is one shingle, one without has none."""
    hashes = word_hashes(text) if text else np.zeros(0, np.uint64)
    n = len(hashes)
    if n == 0:
        return hashes
    if n < words:
        return mix64(*(hashes[i : i + 1] for i in range(n)), np.array([n]))
    return np.unique(mix64(*(hashes[i : n - words + 1 + i] for i in range(words))))


def set_key(shingles: np.ndarray) -> str:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).hexdigest()


@functools.cache
def _second_permutation(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    """Every window of ``coordinates`` neighbours of one fixed permutation of the places, wrapping around; and its inverse."""
    ring = np.empty(UNIVERSE + coordinates, np.uint32)
    ring[:UNIVERSE] = np.argsort((mix64(np.arange(UNIVERSE, dtype=np.uint32)) >> np.uint64(32)).astype(np.uint32), kind="stable")
    ring[UNIVERSE:] = ring[:coordinates]
    back = np.empty(UNIVERSE, np.uint32)
    back[ring[:UNIVERSE]] = np.arange(UNIVERSE, dtype=np.uint32)
    return np.lib.stride_tricks.sliding_window_view(ring, coordinates), back


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash: coordinate k is the least value of the second permutation, shifted by k, over the set.

    The first permutation is an odd multiplication of the hash. Its leading 20 bits name a place, on which the second one
    and the shift act, and the next 32 bits rank the shingles of one place, so the universe has 2^52 values and sets of
    any length can be told apart. All coordinates of one place are neighbours in the second permutation, so they are
    read together; the shingle a coordinate comes from follows from its value by the inverse.
    """
    windows, back = _second_permutation(coordinates)
    hashed = np.sort(shingles * np.uint64(0x9E3779B97F4A7C15))
    places = (hashed >> np.uint64(44)).astype(np.int64)
    first = np.flatnonzero(np.diff(places, prepend=-1))
    places, rank = places[first], hashed[first] >> np.uint64(12) & np.uint64(0xFFFFFFFF)
    least = np.full(coordinates, UNIVERSE, np.uint32)
    for at in range(0, len(places), 512):
        np.minimum(least, windows[places[at : at + 512]].min(axis=0), out=least)
    own = (back[least] - np.arange(coordinates)) % UNIVERSE
    return least.astype(np.uint64) << np.uint64(32) | rank[np.searchsorted(places, own)]


def bands(found: np.ndarray, rows: int) -> np.ndarray:
    """A hash of each band of ``rows`` coordinates, told apart by the band's number."""
    table = found.reshape(-1, rows)
    return mix64(*table.T, np.arange(len(table))).view(np.int64)

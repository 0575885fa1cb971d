"""Words of texts as arrays of code points, many texts at a time; runs inside tasks."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

# First and last code point of the ranges in which a script has its letters.
SCRIPT_RANGES = [
    ("latin", 0x0041, 0x024F),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x0370, 0x03FF),
    ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F),
    ("arabic", 0x08A0, 0x08FF),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("gurmukhi", 0x0A00, 0x0A7F),
    ("gujarati", 0x0A80, 0x0AFF),
    ("tamil", 0x0B80, 0x0BFF),
    ("telugu", 0x0C00, 0x0C7F),
    ("kannada", 0x0C80, 0x0CFF),
    ("malayalam", 0x0D00, 0x0D7F),
    ("sinhala", 0x0D80, 0x0DFF),
    ("thai", 0x0E00, 0x0E7F),
    ("lao", 0x0E80, 0x0EFF),
    ("tibetan", 0x0F00, 0x0FFF),
    ("burmese", 0x1000, 0x109F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF),
    ("hangul", 0xAC00, 0xD7AF),
    ("ethiopic", 0x1200, 0x139F),
    ("khmer", 0x1780, 0x17FF),
    ("mongolian", 0x1800, 0x18AF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x4DBF),
    ("han", 0x4E00, 0x9FFF),
    ("han", 0xF900, 0xFAFF),
    ("han", 0x20000, 0x3FFFF),
]
SCRIPTS = ["other", *dict.fromkeys(name for name, _, _ in SCRIPT_RANGES)]
POINTS = 0x110000
PIECE = 1 << 19


@functools.cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: whether it is a letter, its lower case (where that is one code point), its script."""
    letter = np.fromiter((chr(i).isalpha() for i in range(POINTS)), bool, POINTS)
    lower = np.arange(POINTS, dtype=np.uint32)
    for i in np.flatnonzero(np.fromiter((chr(i).isupper() for i in range(POINTS)), bool, POINTS)).tolist():
        small = chr(i).lower()
        lower[i] = ord(small) if len(small) == 1 else i
    script = np.zeros(POINTS, np.uint8)
    for name, first, last in SCRIPT_RANGES:
        script[first : last + 1] = SCRIPTS.index(name)
    return letter, lower, script


@dataclass
class Words:
    """Letters of a piece of text with their neighbours, and the words they form."""

    letters: np.ndarray  # lower-cased code points of the letters
    before: np.ndarray  # the letter before in the same word, 0 at its start
    after: np.ndarray  # the letter after in the same word, 0 at its end
    first: np.ndarray  # index of each word's first letter in ``letters``
    size: np.ndarray  # letters in each word
    at: np.ndarray  # code point offset of each word in the piece


def words(points: np.ndarray) -> Words:
    letter, lower, _ = tables()
    is_letter = letter[points]
    where = np.flatnonzero(is_letter)
    letters = lower[points[where]]
    gap = np.empty(len(where), bool)
    gap[:1] = True
    np.greater(np.diff(where), 1, out=gap[1:])
    first = np.flatnonzero(gap)
    before = np.zeros_like(letters)
    before[1:] = letters[:-1]
    before[first] = 0
    after = np.zeros_like(letters)
    after[:-1] = letters[1:]
    after[first[1:] - 1] = 0
    size = np.diff(np.append(first, len(letters)))
    return Words(letters, before, after, first, size, where[first])


def pieces(texts: list[str | None], limit: int = PIECE) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int]]]]:
    """Groups of texts of about ``limit`` code points as one array, with (text number, start, end) of each.

    A longer text comes in several groups, cut before a code point that is no letter if there is one in the last
    4096, so that memory is bounded whatever a text's length.
    """
    letter = tables()[0]
    held: list[np.ndarray] = []
    marks: list[tuple[int, int, int]] = []
    total = 0
    gap = np.zeros(1, np.uint32)
    for number, text in enumerate(texts):
        points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
        while True:
            end = min(len(points), limit)
            if end < len(points):
                near = np.flatnonzero(~letter[points[max(0, end - 4096) : end]])
                if len(near) and max(0, end - 4096) + near[-1] > 0:
                    end = max(0, end - 4096) + int(near[-1])
            if marks and total + end > limit:
                yield np.concatenate(held), marks
                held, marks, total = [], [], 0
            held += [points[:end], gap]
            marks.append((number, total, total + end))
            total += end + 1
            points = points[end:]
            if not len(points):
                break
    if marks:
        yield np.concatenate(held), marks


def mix64(*parts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of equally long arrays."""
    out = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        out ^= part.astype(np.uint64)
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
    return out

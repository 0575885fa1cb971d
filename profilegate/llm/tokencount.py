"""Token counts that follow edits.

A text is cut into segments at single spaces between two other characters, where every pre-token of a byte-level BPE
ends. The token counts of the segments are the leaves of a sum tree, kept with the document. An edit re-encodes only the
segments it touches, and their neighbours as long as the text no longer has such a space between them; the sums above
the leaves that changed are then brought up to date. The total is that of encoding the edited text anew.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from profilegate.llm.encoding import Encoder, Vocabulary, default_vocabulary
from profilegate.llm.tables import give_back

SEGMENT = 400
TREE = "struct<chars: array<int>, sums: array<long>>"
EDITS = "array<struct<start: long, end: long, text: string>>"
COUNTED = f"before long, after long, edits int, encoded_chars long, tree {TREE}"


def _parts(text: str, size: int) -> Iterator[str]:
    """Segments of about ``size`` characters; every one but the first starts with a space that may be cut before."""
    start = 0
    while True:
        at = text.find(" ", start + size)
        while at > 0 and (text[at - 1].isspace() or text[at + 1 : at + 2].isspace() or at + 1 == len(text)):
            at = text.find(" ", at + 1)
        if at < 0:
            yield text[start:]
            return
        yield text[start:at]
        start = at


def _sums(leaves: list[int]) -> list[int]:
    """A heap: the sum of node i is that of nodes 2 i and 2 i + 1, the leaves are the last half, the total is node 1."""
    n = len(leaves)
    out = [0] * n + leaves
    for i in range(n - 1, 0, -1):
        out[i] = out[2 * i] + out[2 * i + 1]
    return out


def index(encoder: Encoder, text: str, size: int = SEGMENT) -> tuple[list[int], list[int]]:
    """Lengths of the segments and the sum tree over their token counts."""
    parts = list(_parts(text, size))
    return [len(x) for x in parts], _sums([len(encoder.ids(x)) for x in parts])


def total(sums: list[int]) -> int:
    return sums[1] if len(sums) > 1 else 0


def _clean(left: str, right: str) -> bool:
    """Whether two neighbouring pieces of text can be encoded apart."""
    return bool(left) and not left[-1].isspace() and right[:1] == " " and len(right) > 1 and not right[1].isspace()


def edit(encoder: Encoder, text: str, chars: list[int], sums: list[int], edits: list[tuple[int, int, str]], size: int = SEGMENT):
    """The edited text, its segment lengths and sums, how many edits were made and how many characters were encoded.

    Edits are (start, end, replacement) by offsets in ``text``. One that lies outside the text or overlaps an earlier one
    in order of start is left out.
    """
    n = len(chars)
    starts = [0, *accumulate(chars)]
    made, last = [], 0
    for start, end, new in sorted(edits):
        if last <= start <= end <= len(text):
            made.append((start, end, new))
            last = end
    leaf_text: dict[int, str] = {}

    def leaf(i: int) -> str:
        return leaf_text[i] if i in leaf_text else text[starts[i] : starts[i + 1]]

    def leaf_at(position: int) -> int:
        return min(bisect_right(starts, position) - 1, n - 1)

    # Put the new text into the leaves, from the back so that offsets stay those of the old text.
    touched: set[int] = set()
    for start, end, new in reversed(made):
        first, until = leaf_at(start), leaf_at(max(start, end - 1))
        own = leaf(first)
        if first == until:
            leaf_text[first] = own[: start - starts[first]] + new + own[end - starts[first] :]
        else:
            tail = leaf(until)[end - starts[until] :]
            leaf_text[first] = own[: start - starts[first]] + new
            for i in range(first + 1, until):
                leaf_text[i] = ""
            leaf_text[until] = tail
        touched.update(range(first, until + 1))
    chars, sums = list(chars), list(sums)
    encoded, done = 0, -1
    for first in sorted(touched):
        if first <= done:
            continue
        low = high = first
        while high + 1 < n and high + 1 in touched:
            high += 1
        while True:
            region = "".join(leaf(i) for i in range(low, high + 1))
            if low and not _clean(leaf(low - 1), region):
                low -= 1
            elif high + 1 < n and not _clean(region, leaf(high + 1)):
                high += 1
            else:
                break
        parts = list(_parts(region, size))
        slots = high - low + 1
        parts = parts[: slots - 1] + ["".join(parts[slots - 1 :])] if len(parts) > slots else parts + [""] * (slots - len(parts))
        encoded += len(region)
        done = high
        for i, part in zip(range(low, high + 1), parts, strict=True):
            leaf_text[i], chars[i] = part, len(part)
            change = len(encoder.ids(part)) - sums[n + i] if part else -sums[n + i]
            at = n + i
            while at:
                sums[at] += change
                at //= 2
    return "".join(leaf(i) for i in range(n)), chars, sums, len(made), encoded


def find_edits(text: Column, pattern: str | Callable[[str], Iterable[tuple[int, int]]], replacement: str) -> Column:
    """One edit for each match of ``pattern``, or for each (start, end) that a function finds."""

    @F.pandas_udf(EDITS)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if callable(pattern):
            spans = pattern
        else:
            compiled = re.compile(pattern)
            spans = lambda x: (m.span() for m in compiled.finditer(x))
        for batch in batches:
            yield batch.map(lambda x: [{"start": a, "end": b, "text": replacement} for a, b in spans(x or "")])

    return found(text)


_NUMBER = re.compile(r"\+?[0-9][0-9 ().-]{6,}[0-9]")
_NO_SPACE = re.compile(r"[^\s@]+")


def personal_spans(text: str) -> Iterator[tuple[int, int]]:
    """Addresses (no white space or @, an @, the same again) and long numbers, as the first to match from the left on.

    An address is found by its @ and read to both sides, so a text without any costs one search, however long its runs
    without white space are.
    """

    def address(at: int) -> tuple[int, int] | None:
        sign = text.find("@", at)
        while sign >= 0:
            end = _NO_SPACE.match(text, sign + 1)
            if sign > at and end and _NO_SPACE.match(text, sign - 1):
                start = sign - 1
                while start > at and text[start - 1] != "@" and not text[start - 1].isspace():
                    start -= 1
                return start, end.end()
            sign = text.find("@", sign + 1)
        return None

    def number(at: int) -> tuple[int, int] | None:
        found = _NUMBER.search(text, at)
        return found.span() if found else None

    mail, digits = address(0), number(0)
    while mail or digits:
        best = mail if digits is None or (mail is not None and mail[0] <= digits[0]) else digits
        yield best
        if mail is not None and mail[0] < best[1]:
            mail = address(best[1])
        if digits is not None and digits[0] < best[1]:
            digits = number(best[1])


def indexed(text: Column, vocabulary: Vocabulary | None = None) -> Column:
    """The segment tree of a text, to be kept with it; null and empty texts have one empty segment."""
    files = vocabulary or default_vocabulary()

    @F.pandas_udf(TREE)
    def built(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(files)
        for batch in batches:
            yield pd.DataFrame([index(encoder, x or "") for x in batch.tolist()], columns=["chars", "sums"])
        del encoder
        give_back()

    return built(text)


def counted(text: Column, tree: Column, edits: Column, vocabulary: Vocabulary | None = None) -> Column:
    """Tokens before and after the edits, edits made, characters encoded again, and the tree of the edited text.

    Null texts count as empty, null edits as none, null parts of an edit as 0 and no text. ``tree`` is what ``indexed``
    made of the same text.
    """
    files = vocabulary or default_vocabulary()

    @F.pandas_udf(COUNTED)
    def counts(batches: Iterator[tuple[pd.Series, pd.DataFrame, pd.Series]]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(files)
        for texts, trees, wanted in batches:
            out = []
            for body, chars, sums, changes in zip(texts.tolist(), trees["chars"], trees["sums"], wanted, strict=True):
                chars, sums = [int(x) for x in chars], [int(x) for x in sums]
                changes = [] if changes is None else [(int(x["start"] or 0), int(x["end"] or 0), x["text"] or "") for x in changes]
                _, chars, after, made, encoded = edit(encoder, body or "", chars, sums, changes)
                out.append((total(sums), total(after), made, encoded, {"chars": chars, "sums": after}))
            yield pd.DataFrame(out, columns=["before", "after", "edits", "encoded_chars", "tree"])
        del encoder
        give_back()

    return counts(text, tree, edits)

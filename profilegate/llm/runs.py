"""Periodic runs of words, by a suffix automaton whose link tree is coloured through link-cut access.

A run is a stretch of words with smallest period q that can't be extended on either side. Every appended word accesses
its prefix's state in the tree of suffix links: the path from there to the root takes the word's number as last end of an
occurrence. On its way the access meets segments of equal colour, each the last end e of all suffixes up to the length of
the segment's lowest state on the path. If the distance from e to the word is within that length, two copies lie side by
side: a square. Squares are extended to both sides into runs. Each run has a square that is found this way, since the
last occurrence of its root before the second copy's end is the first copy.

Words that can't lie in a run are left out beforehand: within a run, each trigram of words occurs again within a quarter
of the stretch (in general, its ``exponent``-th part). What is left is cut into stretches, and the condition is applied
again to each, until nothing changes. All of this happens inside one task for each document; memory is about 40 numbers
for every word of the longest stretch.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from profilegate.llm.tables import give_back

LEAST_LENGTH = 6
EXPONENT = 4
GROUP_WORDS = 1 << 17
RESULT = "n_words long, start array<long>, length array<long>, period array<long>, collapsed string"


def _links(words: list[int]) -> tuple[array, array, array]:
    """Suffix automaton: length and suffix link of every state from 1 on (0: the initial one), and the state of each prefix."""
    length, link, symbol, target = array("i", [0]), array("i", [-1]), array("i", [-1]), array("i", [0])
    more: dict[int, dict[int, int]] = {}  # transitions besides a state's first
    prefix = array("i")
    last = 0
    for word in words:
        state = len(length)
        length.append(length[last] + 1)
        symbol.append(-1)
        target.append(0)
        prefix.append(state)
        at, old = last, -1
        while at >= 0:
            first = symbol[at]
            if first == word:
                old = target[at]
                break
            if first < 0:
                symbol[at], target[at] = word, state
            else:
                others = more.get(at)
                if others is None:
                    more[at] = {word: state}
                elif word in others:
                    old = others[word]
                    break
                else:
                    others[word] = state
            at = link[at]
        if old < 0:
            link.append(0)
        elif length[at] + 1 == length[old]:
            link.append(old)
        else:
            clone = state + 1
            link.append(clone)
            length.append(length[at] + 1)
            link.append(link[old])
            symbol.append(symbol[old])
            target.append(target[old])
            if old in more:
                more[clone] = dict(more[old])
            link[old] = clone
            while at >= 0:
                if symbol[at] == word:
                    if target[at] != old:
                        break
                    target[at] = clone
                else:
                    others = more.get(at)
                    if others is None or others.get(word) != old:
                        break
                    others[word] = clone
                at = link[at]
        last = state
    return length, link, prefix


def squares(words: list[int]) -> Iterator[tuple[int, int]]:
    """(end, half): words[end - 2 * half + 1 : end + 1] is twice the same; the first square of every run is among them.

    The link tree is kept as splay trees of preferred paths, linked by ``up``; the initial state is left out. ``seen``
    holds the last end of a whole path, at the root of its splay tree.
    """
    length, link, prefix = _links(words)
    up = link
    up[0] = 0
    left, right = array("i", bytes(4 * len(up))), array("i", bytes(4 * len(up)))
    seen = array("i", [-1]) * len(up)
    for end, state in enumerate(prefix):
        below, x = 0, state
        while x:
            while True:  # splay x to the root of its path
                y = up[x]
                if not y or (left[y] != x and right[y] != x):
                    break
                z = up[y]
                inner = z and (left[z] == y or right[z] == y)
                if inner:
                    # The parent goes up first if both turn to the same side, else x does.
                    turns = ((z, y), (y, x)) if (left[z] == y) == (left[y] == x) else ((y, x), (z, x))
                else:
                    turns = ((y, x),)
                for parent, child in turns:
                    over = up[parent]
                    if left[parent] == child:
                        moved = left[parent] = right[child]
                        right[child] = parent
                    else:
                        moved = right[parent] = left[child]
                        left[child] = parent
                    if moved:
                        up[moved] = parent
                    up[parent], up[child] = child, over
                    if over and left[over] == parent:
                        left[over] = child
                    elif over and right[over] == parent:
                        right[over] = child
                    else:
                        seen[child] = seen[parent]
            before = seen[x]
            if before >= 0 and end - before <= length[x]:
                yield end, end - before
            deeper = right[x]
            if deeper:
                seen[deeper] = before
            right[x] = below
            below, x = x, up[x]
        seen[below] = end


def _is_power(words: list[int], start: int, period: int) -> bool:
    """Whether the ``period`` words from ``start`` on are a shorter word sequence several times over."""
    rest, factor = period, 2
    while rest > 1:
        if factor * factor > rest:
            factor = rest
        if rest % factor == 0:
            step = period // factor
            if words[start : start + period - step] == words[start + step : start + period]:
                return True
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return False


def runs_of(words: list[int], least_length: int = LEAST_LENGTH, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of at least ``least_length`` words and ``exponent`` periods."""
    n, found = len(words), []
    reach: dict[int, int] = {}  # by period: end of the last stretch looked at
    for end, half in squares(words):
        if reach.get(half, -1) >= end:
            continue
        start, stop = end - 2 * half + 1, end + 1
        while start and words[start - 1] == words[start - 1 + half]:
            start -= 1
        while stop < n and words[stop] == words[stop - half]:
            stop += 1
        reach[half] = stop - 1
        if stop - start >= max(least_length, exponent * half) and not _is_power(words, start, half):
            found.append((start, stop - start, half))
    return sorted(found, key=lambda run: (run[0], run[2]))


def _trigrams(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A number for each trigram of ids that starts at ``at``, equal for equal trigrams only."""
    size = int(ids.max(initial=0)) + 1
    pair = ids[at] * size + ids[at + 1]
    if size**3 >= 1 << 63:
        pair = np.unique(pair, return_inverse=True)[1]
    return pair * size + ids[at + 2]


def stretches(ids: np.ndarray, low: np.ndarray, high: np.ndarray, least_length: int = LEAST_LENGTH, exponent: int = EXPONENT) -> tuple[np.ndarray, np.ndarray]:
    """Parts [low, high) of the given stretches that hold all their runs; stretches may not touch each other."""
    while True:
        long = high - low >= least_length
        low, high = low[long], high[long]
        if not len(low):
            return low, high
        starts = high - low - 2
        own = np.repeat(np.arange(len(low)), starts)
        at = np.arange(len(own)) + np.repeat(low - np.cumsum(starts) + starts, starts)
        key = _trigrams(ids, at)
        order = np.argsort(key, kind="stable")
        key, at, own = key[order], at[order], own[order]
        near = (key[1:] == key[:-1]) & (own[1:] == own[:-1]) & (at[1:] - at[:-1] <= ((high - low) // exponent)[own[1:]])
        again = np.zeros(len(at), bool)
        again[1:] |= near
        again[:-1] |= near
        covered = np.zeros(len(ids) + 2, bool)
        for shift in range(3):
            covered[at[again] + shift] = True
        edge = np.flatnonzero(np.diff(covered.view(np.int8), prepend=np.int8(0)))
        total = (high - low).sum()
        low, high = edge[::2], edge[1::2]
        if (high - low).sum() == total:
            return low, high


def _numbered(texts: list[str | None]) -> Iterator[list[tuple[list[bytes], int]]]:
    """Groups of texts as (words, place of the first in the group); a place is free after each text."""
    group, total = [], 0
    for text in texts:
        words = (text or "").encode("utf-8", "surrogatepass").split()
        if group and total + len(words) > GROUP_WORDS:
            yield group
            group, total = [], 0
        group.append((words, total))
        total += len(words) + 1
    if group:
        yield group


def runs_of_texts(texts: list[str | None], least_length: int, exponent: int) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """Words and runs of each text."""
    for group in _numbered(texts):
        number: dict[bytes, int] = {}
        known = number.setdefault
        ids = np.zeros(group[-1][1] + len(group[-1][0]) + 1, np.int64)
        for words, first in group:
            ids[first : first + len(words)] = [known(word, len(number)) for word in words]
        firsts = np.array([first for _, first in group])
        low, high = stretches(ids, firsts, firsts + [len(words) for words, _ in group], least_length, exponent)
        found: list[list[tuple[int, int, int]]] = [[] for _ in group]
        owner = np.searchsorted(firsts, low, "right") - 1
        for text, a, b in zip(owner.tolist(), low.tolist(), high.tolist(), strict=True):
            shift = a - group[text][1]
            local: dict[int, int] = {}
            part = [local.setdefault(i, len(local)) for i in ids[a:b].tolist()]
            found[text] += [(start + shift, length, period) for start, length, period in runs_of(part, least_length, exponent)]
        for (words, _), runs in zip(group, found, strict=True):
            yield words, runs


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by a space, without those that a run repeats after its first period."""
    if runs:
        drop = np.zeros(len(words), bool)
        for start, length, period in runs:
            drop[start + period : start + length] = True
        words = [words[i] for i in np.flatnonzero(~drop).tolist()]
    return b" ".join(words)


def periodic_runs(text: Column, least_length: int = LEAST_LENGTH, exponent: int = EXPONENT) -> Column:
    """A struct: n_words, start, length and period of every run (by start, then period), and collapsed.

    Words are separated by characters of [\\x20\\x09-\\x0D]. A run has at least ``least_length`` words (5 or more) and
    ``exponent`` periods (3 or more). ``collapsed`` has the words joined by one space, each run cut to its first period. Null and
    empty texts, and those of white space alone, have no words, no runs and an empty ``collapsed``; rows are judged one by
    one, so repeated ids, other columns and empty tables need no care.
    """
    if least_length < 5 or exponent < 3:
        raise ValueError("runs have at least 5 words and 3 periods")

    @F.pandas_udf(RESULT)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for words, runs in runs_of_texts(batch.tolist(), least_length, exponent):
                start, length, period = (list(x) for x in zip(*runs, strict=True)) if runs else ([], [], [])
                rows.append((len(words), start, length, period, collapsed(words, runs).decode("utf-8", "replace")))
            yield pd.DataFrame(rows, columns=["n_words", "start", "length", "period", "collapsed"])
        give_back()

    return found(text)

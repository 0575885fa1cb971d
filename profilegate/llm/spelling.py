"""Spelling variants: words one inserted, deleted or replaced code point apart, found by dense prefix-suffix tiling.

1. Words are counted inside the tasks and again after a shuffle.
2. Of two words at one edit, the longer of length b, the edit lies in some window of its code points; what stands before
   and behind the window is the same in both. So the two meet in a bucket named by b, the window and these two ends. Windows
   are the halves of b at first. A bucket of more than ``MOST_HELD`` words is halved again, down to windows of one code
   point, whose buckets hold no more words than there are letters. Nothing is capped.
3. Rows sorted by bucket are cut into blocks. Each block is a padded matrix of code points, and block pairs that share a
   bucket are compared as a whole: common prefix plus common suffix reaching b - 1 tells a single edit. The place of the
   edit is in one window only, so every pair counts once. What leaves a task is one row for each word and bucket: the
   number of its near words and the commonest of them.
4. A word's form is its commonest near word if that is at least twice as common. Chains of forms end after a few steps,
   since counts double; they are followed by joins that double the way.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilegate.llm.tables import Work, give_back, id_text

LEAST_LENGTH = 5
LEAST_COUNT = 3
MOST_HELD = 1024
BLOCK = 128
BLOCK_POINTS = 1 << 20
HELD_ROWS = 1 << 14
HELD_POINTS = 1 << 22
MOST_COUNTED = 200_000
# By byte of latin-1: A-Z lowered, a-z and C0-FF kept, all others a space.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))

# Given a document's id as text, a change to its runs.
Edit = Callable[[bytes], Callable[[bytes], bytes]]


def runs(text: str | None) -> list[bytes]:
    """Maximal runs of [A-Za-z\\u00C0-\\u00FF] in latin-1, with A-Z in lower case."""
    return (text or "").encode("latin-1", "replace").translate(_LETTERS).split()


def thinned(doc_id: bytes, every: int = 97) -> Callable[[bytes], bytes]:
    """Takes one letter from a document's run where the hash of document and run says so."""
    seed = zlib.crc32(doc_id + b":")

    def edit(run: bytes) -> bytes:
        known = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
        if known % every:
            return run
        at = known % len(run)
        return run[:at] + run[at + 1 :]

    return edit


def word_counts(docs: DataFrame, edit: Edit | None = None, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word and n: runs of letters in ``docs`` (doc_id, text) of so many code points that occur so often.

    ``edit`` may change a document's runs, in latin-1, before they are counted. A null text has no words, a null id is
    empty text, and repeated rows count each time.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter[bytes] = Counter()

        def flushed() -> pd.DataFrame:
            out = pd.DataFrame({"word": [w.decode("latin-1") for w in total], "n": list(total.values())})
            total.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch["id"].tolist(), batch["text"].tolist(), strict=True):
                own = Counter(runs(text))
                change = edit(doc_id.encode()) if edit is not None else None
                for run, n in own.items():
                    if len(run) >= least_length:
                        if change is not None:
                            run = change(run)
                        if len(run) >= least_length:
                            total[run] += n
                if len(total) > MOST_COUNTED:
                    yield flushed()
        if total:
            yield flushed()
        give_back()

    rows = docs.select(id_text(F.col("doc_id")).alias("id"), "text").mapInPandas(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _windows(rows: DataFrame) -> DataFrame:
    """Adds the bucket of each row's window [low, high) of ``longer`` code points."""
    head = F.substring("word", F.lit(1), F.col("low"))
    rest = F.col("longer") - F.col("high")
    tail = F.when(rest > 0, F.substring(F.col("word"), F.length("word") - rest + 1, rest)).otherwise(F.lit(""))
    return rows.withColumn("bucket", F.xxhash64("longer", "low", "high", head, tail))


def _halves(rows: DataFrame) -> DataFrame:
    """Each row twice, once for each half of its window; a window of one code point isn't halved."""
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    window = lambda low, high: F.struct(low.alias("low"), high.alias("high"))
    both = F.explode(F.array(window(F.col("low"), middle), window(middle, F.col("high")))).alias("window")
    return rows.select("word", "n", "longer", both).select("word", "n", "longer", "window.low", "window.high")


def _blocks(longer: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts rows into blocks of at most ``BLOCK`` rows and about ``BLOCK_POINTS`` code points."""
    start = 0
    while start < len(longer):
        width = np.maximum.accumulate(longer[start : start + BLOCK])
        fits = width * np.arange(1, len(width) + 1) <= BLOCK_POINTS
        size = max(1, int(fits.sum()))
        yield start, start + size
        start += size


def _matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points by place and word, padded with zeros, from the front and from the back."""
    width = max(map(len, words))

    def table(parts: list[str]) -> np.ndarray:
        return np.ascontiguousarray(np.array(parts, f"<U{width}").view(np.uint32).reshape(len(parts), width).T)

    return table(words), table([word[::-1] for word in words])


def _common(one: np.ndarray, two: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """Length of the common beginning of every two columns, as far as both are long."""
    alive = alive.copy()
    out = np.zeros(alive.shape, np.int32)
    for a, b in zip(one, two, strict=False):
        alive &= a[:, None] == b[None, :]
        if not alive.any():
            break
        out += alive
    return out


def compare_blocks(rows: pd.DataFrame) -> pd.DataFrame:
    """word, n, n_near and the commonest near word with its count, of rows sorted by bucket, falling n and word."""
    words = rows["word"].tolist()
    longer, low, high = (rows[c].to_numpy(np.int64) for c in ("longer", "low", "high"))
    # Places in the given order; equal hashes of unlike windows are told apart, too.
    change = np.ones(len(rows), bool)
    change[1:] = (np.diff(rows["bucket"].to_numpy()) != 0) | (np.diff(longer) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0)
    bucket = np.cumsum(change)
    size = np.fromiter(map(len, words), np.int64, len(words))
    n_near = np.zeros(len(rows), np.int64)
    best = np.full(len(rows), len(rows), np.int64)
    blocks = list(_blocks(longer))
    # The blocks at hand hold a bounded number of code points in all, and so do their matrices.
    tables = [_matrix(words[a:b]) for a, b in blocks]
    for i, (a, b) in enumerate(blocks):
        for j in range(i, len(blocks)):
            c, d = blocks[j]
            if bucket[c] > bucket[b - 1]:
                break
            alive = bucket[a:b, None] == bucket[None, c:d]
            alive &= (size[a:b, None] == longer[a:b, None]) | (size[None, c:d] == longer[a:b, None])
            if i == j:
                np.fill_diagonal(alive, False)
            prefix = _common(tables[i][0], tables[j][0], alive)
            suffix = _common(tables[i][1], tables[j][1], alive)
            last = longer[a:b, None] - 1
            at = np.minimum(prefix, last)
            near = alive & (prefix + suffix >= last) & (at >= low[a:b, None]) & (at < high[a:b, None])
            if not near.any():
                continue
            n_near[a:b] += near.sum(1)
            some = near.any(1)
            best[a:b][some] = np.minimum(best[a:b][some], near.argmax(1)[some] + c)
            if j > i:
                n_near[c:d] += near.sum(0)
                some = near.any(0)
                best[c:d][some] = np.minimum(best[c:d][some], near.argmax(0)[some] + a)
    found = np.flatnonzero(n_near)
    n = rows["n"].to_numpy()
    return pd.DataFrame(
        {
            "word": [words[k] for k in found.tolist()],
            "n": n[found],
            "n_near": n_near[found],
            "form": [words[k] for k in best[found].tolist()],
            "form_n": n[best[found]],
        }
    )


def _compared(rows: DataFrame) -> DataFrame:
    """``compare_blocks`` over whole buckets, many of them at a time."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        count = points = 0
        for batch in batches:
            held.append(batch)
            count += len(batch)
            points += int(batch["longer"].sum())
            if count < HELD_ROWS and points < HELD_POINTS:
                continue
            rows = pd.concat(held, ignore_index=True)
            whole = int(np.argmax(rows["bucket"].to_numpy() == rows["bucket"].iloc[-1]))
            if whole:
                yield from some(compare_blocks(rows[:whole]))
            held = [rows[whole:]]
            count, points = len(held[0]), int(held[0]["longer"].sum())
        if count:
            yield from some(compare_blocks(pd.concat(held, ignore_index=True)))
        give_back()

    def some(found: pd.DataFrame) -> Iterator[pd.DataFrame]:
        # A table without rows has text columns without a chunk, which Arrow refuses.
        if len(found):
            yield found

    dealt = rows.repartition("bucket").sortWithinPartitions("longer", "bucket", F.col("n").desc(), "word")
    return dealt.mapInPandas(compare, "word string, n long, n_near long, form string, form_n long")


def near_words(work: Work, words: DataFrame, most_held: int = MOST_HELD) -> DataFrame:
    """For each word and bucket in which it has near words: word, n, n_near, form (the commonest there), form_n."""
    longer = F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("longer")
    rows = words.filter("word != ''").select("word", "n", longer).withColumns({"low": F.lit(0), "high": F.col("longer")})
    rows = work.land(_windows(_halves(rows.select("word", "n", "longer", "low", "high"))), "windows")
    out = None
    while True:
        held = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
        sized = work.land(rows.join(held, "bucket"), "sized")
        whole = (F.col("held") <= most_held) | (F.col("high") - F.col("low") == 1)
        ready = sized.filter(whole)
        found = work.land(_compared(ready.drop("held")), "near")
        out = found if out is None else out.unionByName(found)
        large = sized.filter(~whole)
        if large.isEmpty():
            return out
        rows = work.land(_windows(_halves(large)), "windows")


def roots(work: Work, forms: DataFrame) -> DataFrame:
    """word and root of ``forms`` (word, form): forms are followed to the last, which has none."""
    out = work.land(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = out.select(F.col("word").alias("at"), F.col("root").alias("next"))
        after = out.join(step, F.col("root") == F.col("at"), "left")
        after = work.land(after.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        out = after.drop("moved")
        if after.filter("moved").isEmpty():
            return out


def variants(work: Work, words: DataFrame, times: int = 2, most_held: int = MOST_HELD) -> DataFrame:
    """word, n, n_near, form, form_n, root of ``words`` (word, n: long), each word once.

    A form is the near word of largest n, of these the first in code-point order, if that n is at least ``times`` the
    word's own; without one, form and form_n are null and the word is its own root. A null word is left out, an empty one
    has no near words, and an empty table gives an empty one.
    """
    words = work.land(words.filter("word IS NOT NULL").select("word", "n"), "words")
    near = near_words(work, words, most_held)
    none = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("string").alias("form"), F.lit(None).cast("long").alias("form_n"))
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("less"), "form"))).alias("best")
    folded = none.unionByName(near).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best)
    common = -F.col("best.less") >= times * F.col("n")
    folded = folded.select(
        "word", "n", "n_near", F.when(common, F.col("best.form")).alias("form"), F.when(common, -F.col("best.less")).alias("form_n")
    )
    folded = work.land(folded, "forms")
    end = roots(work, folded.filter("form IS NOT NULL")).withColumnRenamed("word", "of")
    out = folded.join(end, F.col("word") == F.col("of"), "left")
    return out.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))

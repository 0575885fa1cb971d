"""Encoding, edit-aware counts and packing against the tokenizer itself."""

import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from profilegate.llm import packing, tokencount
from profilegate.llm.encoding import Encoder, default_vocabulary
from profilegate.llm.tables import Work

PARTS = [" ", " ", " ", "  ", "\n", "\t", "a", "é", "Word", "'s", "'ll", "12", "!?", "\xa0", "漢", "hello", "\r\n", "\x1c", "\x85", " "]
EDGE = [None, "", " ", "\n\n", "x", "one two", "one two", "<|endoftext|> in text", "long " * 3000, "y" * 5000]


def test_personal_spans_are_the_matches_of_a_pattern():
    pattern = re.compile(r"[^\s@]+@[^\s@]+|\+?[0-9][0-9 ().-]{6,}[0-9]")
    rnd = random.Random(2)
    for _ in range(20_000):
        text = "".join(rnd.choice(["@", "a", "b.c", " ", "\xa0", "+", "1", "23", "4567890", "-", "(", "\n"]) for _ in range(rnd.randint(0, 14)))
        assert list(tokencount.personal_spans(text)) == [m.span() for m in pattern.finditer(text)]


def test_personal_spans_of_long_texts_take_little_time():
    started = time.monotonic()
    for text in ("x" * 1_000_000, "漢字" * 500_000, "ab1" * 300_000 + "@", "a@" * 300_000, "x" * 1_000_000 + "@y", "@" * 1_000_000, "1 (" * 300_000):
        assert sum(1 for _ in tokencount.personal_spans(text)) < 200_000
    assert time.monotonic() - started < 20


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_vocabulary().tokenizer)


@pytest.fixture(scope="module")
def encoder():
    return Encoder(default_vocabulary())


def ids(tokenizer, text):
    return tokenizer.encode(text, add_special_tokens=False).ids


def random_text(rnd, most=60):
    return "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, most)))


def test_ids_are_the_tokenizers(tokenizer, encoder):
    rnd = random.Random(1)
    for text in [random_text(rnd, 12) for _ in range(3000)] + [x for x in EDGE if x is not None]:
        assert encoder.ids(text) == ids(tokenizer, text), repr(text)


def test_edits_keep_counts_of_the_whole_text(tokenizer, encoder):
    rnd = random.Random(2)
    for _ in range(400):
        text = random_text(rnd)
        chars, sums = tokencount.index(encoder, text, size=6)
        assert tokencount.total(sums) == len(ids(tokenizer, text))
        for _ in range(3):
            edits = []
            for _ in range(rnd.randint(0, 4)):
                start = rnd.randint(0, len(text))
                edits.append((start, min(len(text), start + rnd.choice([0, 1, 3, 20])), random_text(rnd, 5)))
            text, chars, sums, made, _ = tokencount.edit(encoder, text, chars, sums, edits, size=6)
            assert sum(chars) == len(text)
            assert tokencount.total(sums) == len(ids(tokenizer, text))
            assert made <= len(edits)


def test_an_edit_encodes_its_region_only(encoder):
    text = "some words in a row " * 2000
    chars, sums = tokencount.index(encoder, text)
    new, _, after, made, encoded = tokencount.edit(encoder, text, chars, sums, [(20_000, 20_004, "X"), (-1, 3, "out"), (19_999, 20_002, "")])
    assert made == 1 and encoded < 3 * tokencount.SEGMENT
    assert tokencount.total(after) == len(encoder.ids(new))


def test_counted_columns(spark, tokenizer):
    rows = [(i, x, [(0, 1, "Z"), (None, None, None)] if i % 2 else None) for i, x in enumerate(EDGE)]
    df = spark.createDataFrame(rows, f"doc_id long, text string, edits {tokencount.EDITS}")
    out = df.select("doc_id", "text", "edits", tokencount.counted(F.col("text"), tokencount.indexed(F.col("text")), F.col("edits")).alias("c"))
    for row in out.collect():
        text = row["text"] or ""
        edited = "Z" + text[1:] if row["edits"] and text else text
        assert row["c"]["before"] == len(ids(tokenizer, text))
        assert row["c"]["after"] == len(ids(tokenizer, edited))
    assert out.limit(0).count() == 0


def test_best_fit_leaves_no_two_bins_that_fit_together():
    rnd = random.Random(3)
    for _ in range(50):
        lengths = np.array([rnd.randint(1, 64) for _ in range(rnd.randint(0, 200))], np.int64)
        bins, offsets, fill = packing.best_fit(lengths, 64)
        assert sum(fill) == lengths.sum() and all(0 < x <= 64 for x in fill)
        assert all(fill[i] + fill[j] > 64 for i in range(len(fill)) for j in range(i))
        for b in range(len(fill)):
            own = sorted((int(o), int(n)) for x, o, n in zip(bins, offsets, lengths, strict=True) if x == b)
            assert all(a + n == o for (a, n), (o, _) in zip(own, own[1:], strict=False)) and own[0][0] == 0


def check_packing(rows, length):
    by_sequence = {}
    for row in rows:
        by_sequence.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for parts in by_sequence.values():
        parts.sort()
        assert parts[0][0] == 0
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:], strict=False))
        assert sum(n for _, n in parts) <= length
    return by_sequence


def test_documents_round_trip(spark, tokenizer):
    texts = EDGE + [f"document {i} " * (i % 37) for i in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    work = Work(spark)
    packed = work.land(packing.pack_documents(work, df, length=256))
    rows = packed.collect()
    sequences = check_packing(rows, 256)
    total = sum(r["length"] for r in rows)
    assert len(sequences) <= -(-total // 256) + 2
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(df, packed, length=256).collect()}
    found = {}
    for row in rows:
        own = whole[row["sequence_id"]][row["offset"] : row["offset"] + row["length"]]
        assert zlib.crc32(np.array(own, "<u4").tobytes()) == row["ids_crc32"]
        found.setdefault(row["doc_id"], {})[row["piece"]] = (row["start"], own)
    for doc_id, text in enumerate(texts):
        pieces = [found[doc_id][k] for k in range(len(found[doc_id]))]
        joined = []
        for start, own in pieces:
            assert start == len(joined)
            joined += own
        assert joined == ids(tokenizer, text or "") + [0]
        assert all(len(own) == 256 for _, own in pieces[1:])


def test_small_blocks_merge_up_the_tree(spark):
    rnd = random.Random(4)
    df = spark.createDataFrame([(i, rnd.randint(1, 40)) for i in range(3000)], "item long, length long")
    rows = packing.pack(Work(spark), df, length=100, block=20).collect()
    assert len(rows) == 3000
    sequences = check_packing(rows, 100)
    total = sum(r["length"] for r in rows)
    blocks = 3000 / 20
    assert len(sequences) <= total / 100 * 1.02 + blocks / 4


def test_large_items_are_not_gathered(spark):
    df = spark.range(2000).selectExpr("id AS item", "CAST(60 AS BIGINT) AS length")
    rows = packing.pack(Work(spark), df, length=100, block=50).collect()
    assert len({r["sequence_id"] for r in rows}) == 2000


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(Work(spark), empty).count() == 0

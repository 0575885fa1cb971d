"""Exact, near and line deduplication against brute force."""

import hashlib
import random
import re
from itertools import combinations

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from profilegate.llm import dedup, fuse, linededup, neardup, shingles
from profilegate.llm.tables import Work

EDGE = [
    (1, "same  text"), (2, "sametext"), (3, "same\ttext "), (4, None), (5, ""), (6, " \n"), (7, "other"), (7, "other"),
    (8, "Other"), (None, "other"), (None, "alone"), (9, "non breaking"), (10, "nonbreaking"), (11, "long " * 50_000), (12, "long" * 50_000),
]


def test_filters_find_all_they_were_built_on():
    rnd = np.random.default_rng(1)
    for n in (1, 2, 3, 10, 1000, 30_000):
        keys = rnd.integers(-(2**63), 2**63 - 1, n)
        built = fuse.build(np.concatenate([keys, keys]))
        assert fuse.probe(built, keys).all()
        others = rnd.integers(-(2**63), 2**63 - 1, 20_000)
        assert fuse.probe(built, others).mean() < 0.01
        assert len(built) < 60 + (3 if n < 100 else 1.6) * n + 64


def exact_by_hand(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((doc_id, text or ""))
    out = []
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        out += [(i, keep, len(members), i == keep, hashlib.sha256(norm.encode()).hexdigest()) for i, _ in members]
    return sorted(out, key=repr)


def test_exact_duplicates(spark):
    df = spark.createDataFrame(EDGE, "doc_id long, text string")
    got = [tuple(r) for r in dedup.exact_duplicates(Work(spark), df).collect()]
    assert sorted(got, key=repr) == exact_by_hand(EDGE)


def test_colliding_digests_are_told_apart_by_bytes(spark):
    df = spark.createDataFrame(EDGE, "doc_id long, text string")
    weak = lambda text: F.length(text).cast("string")
    got = [tuple(r)[:4] for r in dedup.exact_duplicates(Work(spark), df, weak).collect()]
    assert sorted(got, key=repr) == sorted((x[:4] for x in exact_by_hand(EDGE)), key=repr)


def test_without_duplicates_keeps_one_of_each(spark):
    rows = [(i, t, "x", n) for n, (i, t) in enumerate(EDGE)]
    df = spark.createDataFrame(rows, "doc_id long, text string, gone_id string, gone_key int")
    out = dedup.without_duplicates(Work(spark), df)
    assert out.columns == df.columns
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    want = {(i, t) for i, t in EDGE for e in exact_by_hand(EDGE) if e[0] == i and e[3] and hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t or "").encode()).hexdigest() == e[4]}
    assert len(kept) == len(set(kept)) and set(kept) == want


def shingle_sets(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)} if len(found) >= words else {tuple(found)} - {()}


def near_by_hand(rows, words, percent):
    sets = [(i, shingle_sets(t, words)) for i, t in rows]
    least = {i: i for i, _ in rows}

    def root(x):
        while least[x] != x:
            x = least[x]
        return x

    for (i, a), (j, b) in combinations(sets, 2):
        if a and b and i is not None and j is not None and 100 * len(a & b) >= percent * len(a | b):
            x, y = sorted((root(i), root(j)))
            least[y] = x
    return {i: root(i) for i, _ in rows}


def near_rows():
    rnd = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(0, None), (1, ""), (2, " \n "), (3, "One"), (4, "one"), (5, "one two three"), (6, "ONE two  three"), (None, "one"), (7, "É é")]
    number = 10
    for _ in range(12):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([8, 60, 200]))]
        for _ in range(rnd.choice([1, 2, 25])):
            text = list(base)
            for _ in range(rnd.randint(0, max(1, len(text) // 25))):
                text[rnd.randrange(len(text))] = rnd.choice(vocabulary)
            rows.append((number, " ".join(text)))
            number += 1
    rows += [(number, "very long " * 1), (number + 1, " ".join(f"x{i % 70_000}" for i in range(250_000)))]
    return rows


@pytest.mark.parametrize("words", [4, 5])
def test_near_duplicates(spark, words, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 3)
    rows = near_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r for r in neardup.near_duplicates(Work(spark), df, words).collect()}
    want = near_by_hand(rows, words, 80)
    assert len(got) == len(rows)
    for doc_id, text in rows:
        assert got[doc_id]["n_shingles"] == len(shingle_sets(text, words))
        assert got[doc_id]["component_id"] == want[doc_id]
        assert got[doc_id]["kept"] == (want[doc_id] == doc_id)


def test_a_repeated_id_ties_its_texts(spark):
    rows = [(5, "a b c d e f"), (5, "g h i j k l"), (3, "g h i j k l"), (9, "a b c d e f")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["component_id"] for r in neardup.near_duplicates(Work(spark), df).collect()} == {3}


def test_block_links_join_labels_across_columns(monkeypatch):
    monkeypatch.setattr(neardup, "COLUMNS", 16)
    rnd = random.Random(9)
    base = rnd.sample(range(-500, 500), 60)
    sets = [sorted(set(base[: 60 - k]) | {1000 + k}, key=lambda x: x % 2**64) for k in range(10)]
    group = pd.DataFrame({"node": range(10), "n": [len(s) for s in sets], "label": range(10), "side": [2] * 10, "shingles": [np.array(s) for s in sets]})
    links = neardup.block_links(group, 80)
    for a, b in links:
        x, y = set(sets[a]), set(sets[b])
        assert 100 * len(x & y) >= 80 * len(x | y)
    reached = {0}
    for _ in range(10):
        reached |= {y for x, y in links if x in reached} | {x for x, y in links if y in reached}
    near = {i for i in range(10) if any(100 * len(set(sets[i]) & set(sets[j])) >= 80 * len(set(sets[i]) | set(sets[j])) for j in range(10) if j != i)}
    assert near <= reached


def test_signatures_of_long_unlike_sets_share_nothing():
    rnd = np.random.default_rng(4)
    sets = [np.unique(rnd.integers(0, 2**63, 1_000_000, dtype=np.uint64)) for _ in range(2)]
    one, two = (shingles.signature(x, 216) for x in sets)
    assert not (one == two).any()
    near = shingles.signature(np.union1d(sets[0][100_000:], sets[1][:100_000]), 216)
    assert 0.7 < (one == near).mean() < 0.9 and (shingles.bands(one, 6) == shingles.bands(near, 6)).any()
    assert not np.isin(shingles.bands(one, 6), shingles.bands(two, 6)).any()


def test_signatures_agree_like_the_sets():
    one = np.unique(shingles.mix64(np.arange(2000)))
    two = np.unique(shingles.mix64(np.arange(200, 2200)))
    same = (shingles.signature(one, 512) == shingles.signature(two, 512)).mean()
    assert abs(same - 1800 / 2200) < 0.08


def test_words_longer_than_a_piece(monkeypatch):
    text = "short " + "z" * 300 + " tail " + "é" * 40
    whole = shingles.word_hashes(text).tolist()
    monkeypatch.setattr(shingles, "PIECE", 16)
    shingles._base_powers.cache_clear()
    assert shingles.word_hashes(text).tolist() == whole
    shingles._base_powers.cache_clear()


LINES = ["alpha beta", "gamma delta", "", "  ", "one two three", "x " * 60, "y " * 51, "z", "Licence text", "All rights"]


def test_line_chunks(spark):
    rnd = random.Random(11)
    passages = [[rnd.choice(LINES) + str(rnd.randint(0, 5)) for _ in range(rnd.randint(2, 8))] for _ in range(6)]
    rows = [(0, None), (1, ""), (2, "\n\n"), (3, "x " * 60), (4, "x " * 60), (5, "a\nb\nc"), (6, "a\nb\nc")]
    for i in range(7, 60):
        lines = [rnd.choice(LINES) for _ in range(rnd.randint(0, 5))]
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randint(0, len(lines))
            lines[at:at] = rnd.choice(passages)
        rows.append((i, "\n".join(lines)))
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], "doc_id long, text string, gone int, cut string")
    out = linededup.without_repeated_lines(Work(spark), df)
    assert out.columns == [*df.columns, "removed_lines"]
    documents = pd.DataFrame(rows, columns=["doc_id", "text"])
    con = duckdb.connect()
    con.register("documents", documents)
    want = con.execute(linededup.ORACLE_SQL).fetchall()
    got = [(r["doc_id"], r["removed_lines"], r["text"]) for r in out.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(x[1] for x in got) > 20


def test_rows_with_null_or_repeated_ids_are_documents_of_their_own(spark):
    rnd = random.Random(12)
    passages = ["\n".join(f"{rnd.choice(LINES)} {rnd.randint(0, 9)}" for _ in range(4)) for _ in range(4)]
    texts = [*passages, *("\n".join(rnd.sample(passages, 2)) for _ in range(6))]
    rows = [(rnd.choice([None, None, 1, 2, 3]), rnd.choice([None, *texts])) for _ in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    hashes = {r["text"]: r["h"] for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    seen, want = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, hashes[r[1]])):
        found = linededup.chunks(text) if text is not None else []
        gone = []
        for *_, compared, chunk in found:
            gone.append(compared and chunk in seen)
            seen |= {chunk} if compared else set()
        kept = b"\n".join(c[3] for c, g in zip(found, gone, strict=True) if not g).decode()
        want.append((doc_id, None if text is None else kept, sum(c[1] for c, g in zip(found, gone, strict=True) if g)))
    got = [tuple(r) for r in linededup.without_repeated_lines(Work(spark), df).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    marks = linededup.removals(Work(spark), df.withColumn("row", F.monotonically_increasing_id()).localCheckpoint())
    assert marks.agg(F.max(F.size("gone"))).first()[0] <= max(len(linededup.chunks(t)) for t in texts)


def test_different_bytes_behind_a_digest_are_left(spark, monkeypatch):
    texts = ["a\nb c\nd e", "f\ng h\ni j", "a\nb c\nd e"]
    assert linededup.chunks(texts[0]) and linededup.chunks("") == [(0, 1, False, b"")]
    repeated = spark.createDataFrame([(linededup._digest(b"x"),)], "digest string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert linededup.clashing(Work(spark), docs, repeated).count() == 0


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    work = Work(spark)
    assert dedup.exact_duplicates(work, empty).count() == 0
    assert dedup.without_duplicates(work, empty).count() == 0
    assert neardup.near_duplicates(work, empty).count() == 0
    assert linededup.without_repeated_lines(work, empty).count() == 0

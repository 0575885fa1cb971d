"""Language spans, toxic segments, page text, search and mixing against brute force."""

import random
import re
import time
from itertools import combinations, product

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from profilegate.llm import html, langid, maxscore, mixing, toxicity
from profilegate.llm.codepoints import pieces
from profilegate.llm.tables import Work

SYLLABLES = {"aa": "ba ri to lo mu".split(), "bb": "kse wyn dro pli zhu".split(), "cc": "да ко ли ву ше".split()}


def prose(rnd, lang, n):
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(n))


def path_score(scores, path, penalty):
    return sum(scores[i][j] for i, j in enumerate(path)) - penalty * sum(a != b for a, b in zip(path, path[1:], strict=False))


def test_viterbi_is_the_best_path():
    rnd = np.random.default_rng(1)
    for _ in range(150):
        scores = rnd.normal(size=(rnd.integers(1, 7), 3)).astype(np.float32)
        best = max(path_score(scores, p, 1.0) for p in product(range(3), repeat=len(scores)))
        assert path_score(scores, langid.viterbi(scores.astype(float), 1.0), 1.0) == pytest.approx(best, abs=1e-5)
        assert path_score(scores, langid.decode(scores, 1.0), 1.0) == pytest.approx(best, abs=1e-5)


@pytest.fixture(scope="module")
def language_model(spark):
    rnd = random.Random(3)
    rows = [(i, prose(rnd, lang, 80), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 20)]
    rows += [(None, "ba", "aa"), (100, None, "aa"), (101, "ba ri", None), (102, "", "bb")]
    return langid.fit(Work(spark), spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_languages_and_spans(spark, language_model):
    rnd = random.Random(4)
    one, two, three = (prose(rnd, x, 60) for x in ("aa", "bb", "cc"))
    texts = [one, two, three, None, "", "12 !? 34", one + " " + two * 3, "漢字", "x", "ba ri to " * 90_000, "ba ri to ba ri " + "漢字" * 45]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = {r["doc_id"]: r["l"] for r in df.select("doc_id", langid.label(Work(spark), language_model, F.col("text")).alias("l")).collect()}
    assert [out[i]["lang_pred"] for i in range(7)] == ["aa", "bb", "cc", "und", "und", "und", "bb"]
    assert out[0]["score"] == 1.0 and out[3]["score"] == 0.0 and out[9]["lang_pred"] == "aa"
    assert out[7]["lang_pred"] in SYLLABLES and out[7]["score"] == out[7]["share"] == 0.0 and out[7]["spans"] == []
    assert out[10]["score"] == 1.0 and 0.08 < out[10]["share"] < 0.12 and out[0]["share"] == 1.0
    first, second = out[6]["spans"]
    assert (first["start"], first["lang"], second["lang"]) == (0, "aa", "bb")
    assert abs(first["end"] - len(one)) < 30 and second["end"] == len(texts[6])
    assert len(out[9]["spans"]) == 1 and out[9]["spans"][0]["end"] == len(texts[9]) - 1


def test_nothing_learned(spark):
    model = langid.fit(Work(spark), spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert langid.Labeller(model).label(["some text", None]) == [("und", 0.0, 0.0, []), ("und", 0.0, 0.0, [])]


def test_pieces_hold_every_text():
    texts = ["ab cd " * 50, None, "", "x" * 300, "tail"]
    found = {}
    for points, marks in pieces(texts, 64):
        for number, start, end in marks:
            found[number] = found.get(number, "") + "".join(map(chr, points[start:end]))
    assert found == {i: t or "" for i, t in enumerate(texts)}


def maximal_by_hand(scores):
    """Repeatedly the best remaining segment, shortest first, then both sides of it."""
    if not len(scores) or max(scores) <= 0:
        return []
    best = max(((sum(scores[a : b + 1]), a - b, -a, a, b) for a in range(len(scores)) for b in range(a, len(scores))))
    a, b = best[3], best[4]
    left = maximal_by_hand(scores[:a])
    right = [(x + b + 1, y + b + 1) for x, y in maximal_by_hand(scores[b + 1 :])]
    return [*left, (a, b), *right]


def test_segments_are_all_maximal_ones():
    rnd = random.Random(5)
    for _ in range(300):
        scores = np.array([rnd.choice([-3.0, -1.25, -0.5, 0.75, 1.5, 2.0]) + rnd.random() / 8 for _ in range(rnd.randint(0, 14))])
        got = [(a, b) for a, b, _ in toxicity.maximal_segments(scores)]
        assert got == maximal_by_hand(scores.tolist())


def test_segments_of_long_texts_take_linear_time():
    """One toxic word in twelve, and rises followed by deeper falls: the sum goes down all the way."""
    started = time.monotonic()
    dozen = np.tile(np.array([2.0] + [-0.3] * 11), 1_000_000 // 12)
    assert len(toxicity.maximal_segments(dozen)) == len(dozen) // 12
    assert len(toxicity.maximal_segments(np.tile([1.0, -2.0], 500_000))) == 500_000
    assert len(toxicity.maximal_segments(np.tile([2.0, -1.0], 500_000))) == 1
    rnd = np.random.default_rng(1)
    assert toxicity.maximal_segments(rnd.normal(-0.1, 1, 1_000_000))
    assert time.monotonic() - started < 20


def test_toxic_passages(spark):
    rnd = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        words = prose(rnd, "aa", 60).split()
        if i % 4 == 0:
            for _ in range(4):
                words.insert(rnd.randrange(len(words)), rnd.choice(["grolp", "snurk", "blifft"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0) if i % 5 else None))
    rows += [(None, "grolp"), (1000, None), (1001, ""), (1002, "grolp snurk " * 40_000), (1003, "...")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(Work(spark), docs, spark.createDataFrame([*labels, (None, 1), (3, 7)], "doc_id long, toxic int"))
    out = {r["doc_id"]: r["t"] for r in docs.select("doc_id", toxicity.toxicity(Work(spark), model, F.col("text")).alias("t")).collect()}
    assert all((out[i]["score"] >= 0.5) == (i % 4 == 0) for i in range(600))
    assert out[1000]["score"] == out[1001]["score"] == out[1003]["score"] < 0.5
    assert out[1002]["score"] > 0.99 and out[1002]["tokens"] == 80_000
    text = dict(rows)[0]
    assert any(re.search("grolp|snurk|blifft", text[s["start"] : s["end"]]) for s in out[0]["segments"])
    empty = toxicity.fit(Work(spark), docs.limit(0), spark.createDataFrame([], "doc_id long, toxic int"))
    assert 0 <= toxicity.Scorer(empty).score(["text"])[0][0] < 0.5


def cut_cost(scores, edges, kept):
    cost = sum(abs(s) for s, k in zip(scores, kept, strict=True) if (s > 0) != k and s)
    return cost + sum(c for a, b, c in edges if kept[a] != kept[b])


def test_minimum_cut_is_the_cheapest_labelling():
    rnd = random.Random(7)
    for _ in range(200):
        n = rnd.randint(1, 7)
        scores = [rnd.randint(-9, 9) for _ in range(n)]
        edges = [(a, b, rnd.randint(0, 6)) for a, b in combinations(range(n), 2) if rnd.random() < 0.5]
        best = min(cut_cost(scores, edges, kept) for kept in product([True, False], repeat=n))
        assert cut_cost(scores, edges, html.minimum_cut(scores, edges)) == best


LONG = "words of a reader who has much to say about this " * 6
PAGES = {
    None: "",
    "": "",
    "plain text only, with a few words & more": "plain text only, with a few words & more",
    "<p>a < b&nbsp;and\n\n c<p>second<script>if (a</b) x = '</p>'</script> more<br>line<!-- no --><style>p{}</style>": "a < b and c\nsecond more line",
    "<nav><a href=x>Home</a></nav><article><h1>T</h1><p>Short.</p><aside>See</aside><div class='ad'>Buy</div><p>Last <b>bold</b> one.</article><footer>f</footer>": "T\nShort.\nLast bold one.",
    f"<main><article><p>One</p><div class='post-comments'><article><p>{LONG}</p></article></div></article></main>": "One",
    f"<div id=comments><article><p>{LONG}</p></article></div><main><p>Hi</p></main>": "Hi",
    f"<div class='page has-sidebar'><article><header><h1>T</h1></header><p>Yes</p></article><div class=sidebar><p>{LONG}</p></div></div>": "T\nYes",
    "<header class=site><h1>Site</h1></header><article><p>Body</p><form><label>Name</label></form><p hidden>no</p></article><div class='cookie-notice'>We use them</div>": "Body",
    "<article><p>cut off here &am": "cut off here &am",
    "<article><p>x</p><p attr='never closed>y</p></article>": "x",
    "<ARTICLE><P>Upper &lt;b&gt; &#233;&eacute;</P></ARTICLE>": "Upper <b> éé",
}


def test_pages(spark):
    df = spark.createDataFrame([(i, h) for i, h in enumerate(PAGES)], "page_id long, html string")
    got = {r["page_id"]: r["m"]["text"] for r in df.select("page_id", html.extract(F.col("html")).alias("m")).collect()}
    for i, (page, want) in enumerate(PAGES.items()):
        if "never closed" in (page or ""):
            assert got[i].startswith(want)
        else:
            assert got[i] == want, page
    deep = "<div>" * 3000 + "<article><p>deep</p></article>"
    assert html.main_text(deep)[0] == "deep"


SLUGS = {
    "<article class='post category-legal tag-social'><h1>T</h1><p>Short.</p></article>": "T\nShort.",
    "<main class='has-sidebar'><p>Short.</p></main>": "Short.",
    "<div id='content' class='with-sidebar'><p>Short.</p></div>": "Short.",
    "<article><h1>T</h1><h2 id='related-work'>Related work</h2><p>x</p></article>": "T\nRelated work\nx",
    "<article><h1>T</h1><section id='search'><h2>Search</h2><p>How it works.</p></section></article>": "T\nSearch\nHow it works.",
    f"<main><article class='post comments-open'><h2 id=search>Search</h2><p>{LONG}</p></article></main>": f"Search\n{LONG.strip()}",
    f"<article><p>One</p><section id=comments><p>{LONG}</p></section></article>": "One",
    f"<article><p>One</p><div class=sidebar><p>{LONG}</p></div><div class='related-posts'><a href=x>More</a></div></article>": "One",
    f"<div id=sidebar class=main><p>{LONG}</p></div><article class=comment><p>{LONG}</p></article><main><p>Hi</p></main>": "Hi",
}


def test_names_with_boilerplate_words_are_weighed():
    for page, want in SLUGS.items():
        assert html.main_text(page)[0] == want, page


def test_top_k(spark):
    rnd = np.random.default_rng(8)
    rows = [(i, (rnd.normal(size=8) * rnd.choice([0.02, 1.0])).round(2).tolist()) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 340)] + [(400, [0.0] * 8), (401, [-1.0] * 8)]
    bad = [(500, None), (None, [1.0] * 8), (550, [1.0, None]), (600, [float("nan")]), (650, [float("inf")]), (700, []), (750, [0.5])]
    df = spark.createDataFrame([*rows, *bad], "vec_id long, embedding array<double>")
    good = [(i, np.floor(256 * np.array(v, float)).astype(int)) for i, v in [*rows, (700, []), (750, [0.5])]]
    full = {i: np.pad(v, (0, 8 - len(v))) for i, v in good}
    vectors = maxscore.quantised(df)
    got = [tuple(r) for r in maxscore.top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5).collect()]
    want = []
    for q in full:
        if q % 50 == 0:
            scored = sorted((-int(full[q] @ full[v]), v) for v in full if v != q)[:5]
            want += [(q, rank, v, -s) for rank, (s, v) in enumerate(scored, 1)]
    assert sorted(got) == sorted(want)
    few = vectors.filter("vec_id IN (0, 1, 2)")
    assert maxscore.top_k(few, few, 5).count() == 6
    assert maxscore.top_k(vectors.limit(0), vectors.limit(0), 5).count() == 0


def brute_top(ids, values, query_id, query, k):
    scored = sorted((-sum(int(a) * int(b) for a, b in zip(query, v, strict=True)), i) for i, v in zip(ids, values, strict=True) if i != query_id)
    return [(i, -s) for s, i in scored[:k]]


@pytest.mark.parametrize("kind", [np.float32, np.int64, object])
def test_postings_and_probes_give_the_best(kind):
    rnd = np.random.default_rng(11)
    for width, n in ((1, 40), (3, 200), (12, 300)):
        values = rnd.integers(-9, 10, size=(n, width))
        values[rnd.random((n, width)) < 0.4] = 0
        values[: n // 3] = -np.abs(values[: n // 3])
        ids = rnd.permutation(n) * 3
        shard = maxscore.Shard(ids, values.astype(kind))
        for i in range(0, n, 7):
            for query in (values[i], np.abs(values[i]), np.zeros(width, int)):
                assert shard.search(int(ids[i]), query.astype(kind), 5) == brute_top(ids.tolist(), values, ids[i], query, 5)


def test_reads_stay_below_the_dense_count():
    rnd = np.random.default_rng(12)
    centres = rnd.normal(size=(200, 64))
    near = centres[rnd.integers(0, 200, 6000)] + 0.1 * rnd.normal(size=(6000, 64))
    sparse = rnd.integers(1, 100, size=(6000, 64)) * (rnd.random((6000, 64)) < 0.05)
    for values, most in ((np.floor(40 * near), 0.7), (sparse, 0.25)):
        values = values.astype(np.float32)
        shard = maxscore.Shard(np.arange(6000), values)
        for i in range(0, 6000, 300):
            assert shard.search(i, values[i], 5) == brute_top(range(6000), values, i, values[i], 5)
        assert shard.read < most * 20 * values.size


def test_top_k_of_large_components(spark):
    most = float(2**31 - 1)
    rows = [(0, [most, most, most]), (50, [most, most, 0.0]), (51, [most, 0.0, 1.0]), (52, [most, most, most - 1]), (53, [2.0**31, 0.0, 0.0]), (54, [1e300, 0.0, 0.0])]
    vectors = maxscore.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), scale=1)
    got = sorted(tuple(r) for r in maxscore.top_k(vectors, vectors.filter("vec_id = 0"), 5).collect())
    m = 2**31 - 1
    assert got == [(0, 1, 52, 2**63 - 1), (0, 2, 50, 2 * m * m), (0, 3, 51, m * m + m)]


def test_top_k_of_every_finite_vector_and_row(spark, tmp_path):
    from profilegate.llm import queries

    # Components of 2^31 and more after scaling, up to the largest float, and two rows with one id.
    rows = [(0, [1.0, 1.0]), (1, [2.0**23, 0.0]), (2, [2.0**40, -(2.0**30)]), (3, [3.0e38, -3.0e38]), (4, [-1.0e30, 0.5]), (50, [2.0**25, 1.0]), (50, [0.0, 3.0])]
    bad = [(100, [float("inf"), 0.0]), (5, [None, 1.0]), (6, None), (7, [float("nan"), 0.0])]
    spark.createDataFrame([*rows, *bad], "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = [tuple(r) for r in queries.op4_exact_topk(spark, str(tmp_path)).collect()]
    values = [(i, [int(np.float32(x)) * 256 if abs(x) >= 1 else int(np.floor(256 * x)) for x in v]) for i, v in rows]
    want = []
    for n, (i, q) in enumerate(values):
        if i % 50 == 0:
            scores = [(v, max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(q, c, strict=True))))) for m, (v, c) in enumerate(values) if m != n]
            want += [(i, rank, v, s) for rank, (v, s) in enumerate(sorted(scores, key=lambda x: (-x[1], x[0]))[:5], 1)]
    assert sorted(got) == sorted(want) and len(got) == 15


def mix_rows():
    rnd = random.Random(9)
    rows = [(i, "w " * rnd.randint(0, 30), rnd.choice(["a", "b", "c", "d", None, "é", "z"])) for i in range(400)]
    rows += [(i, "w " * 40, "hot") for i in range(400, 900)]
    return rows + [(None, "w w", "a"), (None, "w", "b"), (1000, None, "a"), (1001, "", "only"), (5, "w w w", "a"), (5, "w w w", "a")]


@pytest.mark.parametrize("rows", [mix_rows(), [], [(1, "w w w", None)], [(1, None, "a"), (2, "", "b")]])
def test_mixing(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    out = mixing.mix_sizes(Work(spark), df).selectExpr("doc_id", "size", "source_size", "target", "size * copies AS taken")
    con = duckdb.connect()
    con.register("frame", pd.DataFrame(rows, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"}))
    con.execute("CREATE VIEW documents AS SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(text AS VARCHAR) AS text, CAST(source AS VARCHAR) AS source FROM frame")
    want = con.execute(mixing.oracle()).fetchall()
    got = [tuple(r) for r in out.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_mix_meets_its_targets(spark):
    df = spark.createDataFrame(mix_rows(), "doc_id long, text string, source string")
    out = mixing.mix(Work(spark), df.withColumn("note", F.lit(1)))
    assert {"note", "text", "copies", "target"} <= set(out.columns)
    sums = out.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"), F.max("copies").alias("most"), F.max("size").alias("size"))
    for row in sums.collect():
        assert row["most"] <= 3 and abs(row["taken"] - row["target"]) <= row["size"] / 2 + 1


def test_mix_keeps_columns_of_any_name(spark):
    names = ["odds", "last", "whole", "missing", "rank", "cell", "size", "copies", "Target", "mix_id", "held", "cut_cell", "a.b"]
    df = spark.createDataFrame(mix_rows(), "doc_id long, text string, source string")
    plain = {tuple(r) for r in mixing.mix(Work(spark), df).collect()}
    wide = df.select("source", *[F.lit(i).alias(n) for i, n in enumerate(names)], "doc_id", "text")
    out = mixing.mix(Work(spark), wide)
    assert out.columns == [*wide.columns, "size_", "source_size", "target_", "copies_"]
    rows = [tuple(r) for r in out.collect()]
    assert all(r[1 : len(names) + 1] == tuple(range(len(names))) for r in rows)
    assert {(*r[len(names) + 1 : len(names) + 3], r[0], *r[len(names) + 3 :]) for r in rows} == plain


def test_unclosed_inline_tags_take_linear_time():
    started = time.monotonic()
    page = "<article><p>start " + "<b>x " * 100_000 + "</article><nav>menu</nav>"
    assert [("".join(b.parts).split()[:2], b.element.tag) for b in html.blocks(page)] == [(["start", "x"], "p"), (["menu"], "nav")]
    assert time.monotonic() - started < 20

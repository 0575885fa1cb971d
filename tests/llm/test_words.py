"""Spelling variants, quality rules and periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from profilegate.llm import quality, queries, runs, spelling
from profilegate.llm.tables import Work

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ROWS = [
    (1, "alpha beta alpha beta alpha beta alpha beta alpha beta tail"),
    (1, "alpha beta alpha beta alpha beta alpha beta alpha beta tail"),
    (2, None), (3, ""), (4, " \n\t "), (None, "x x x x x x x"), (None, None), (5, "one"),
    (6, "Straße ÉCOLE école ecole Ecole écoles ünder under sunder"),
    (7, "line one\nline one\n\nline two\n \n \nline one"),
    (8, "*** $$$ ||| <<< >>> word"),
    (9, "no break no break no break no break no break no break\x1fjoined"),
    (10, "a b c a b c a b c a b c a b c " * 4000),
    (11, "中文没有空格的长句子"), (12, "q" * 300_000),
]


def words_of(text):
    return WORD.findall(text or "")


def random_rows(seed, n, letters="ab", most=80):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        words = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 2))) for _ in range(rnd.randint(0, most))]
        if words and rnd.random() < 0.5:
            first, period = rnd.randrange(len(words)), rnd.randint(1, 9)
            words = [w if j < first else words[min(len(words) - 1, first + (j - first) % period)] for j, w in enumerate(words)]
        out.append((i, rnd.choice([" ", "\n", " \t"]).join(words)))
    return out


# Periodic runs.


def runs_by_hand(w, least=6, exponent=4):
    n, out = len(w), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j + q - i
            if j > i and size >= max(least, exponent * q) and not any(w[i : j + q - p] == w[i + p : j + q] for p in range(1, q)):
                out.append((i, size, q))
            i = j + 1 if j > i else i + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force_on_small_alphabets():
    rnd = random.Random(3)
    for trial in range(3000):
        w = [rnd.randrange(rnd.choice([1, 2, 3])) for _ in range(rnd.randint(0, 50))]
        exponent = 3 + trial % 3
        assert runs.runs_of(w, 6, exponent) == runs_by_hand(w, 6, exponent)
        ((_, pruned),) = runs.runs_of_texts([" ".join(map(str, w))], 6, exponent)
        assert pruned == runs_by_hand(w, 6, exponent)


def test_squares_are_squares_and_start_every_run():
    rnd = random.Random(5)
    for _ in range(500):
        w = [rnd.randrange(2) for _ in range(rnd.randint(0, 40))]
        found = set(runs.squares(w))
        assert all(w[e - 2 * h + 1 : e - h + 1] == w[e - h + 1 : e + 1] and h > 0 for e, h in found)
        assert all((s + 2 * q - 1, q) in found for s, _, q in runs_by_hand(w, 2, 2))


def test_runs_of_a_long_periodic_text_take_little_time():
    text = " ".join(f"w{i % 70_000}" for i in range(300_000))
    ((_, found),) = runs.runs_of_texts([text], 6, 4)
    assert found == [(0, 300_000, 70_000)]


def test_many_distinct_words_in_one_group_keep_trigrams_apart():
    text = " ".join(f"w{i}" for i in range(2_200_000)) + " a b a b a b a b"
    ((_, found),) = runs.runs_of_texts([text], 6, 4)
    assert found == [(2_200_000, 8, 2)]


def op13_by_hand(doc_id, text):
    w = words_of(text)
    n, h = len(w), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = runs_by_hand(w)
    dropped = {i for s, size, q in found for i in range(s + q, s + size)}
    kept = " ".join(x for i, x in enumerate(w) if i not in dropped)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    four = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(found), *four, digest("".join(f"{s},{size},{q}\n" for s, size, q in found)), digest(kept))


def write(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.withColumns({"n": F.lit("x"), "w": F.lit("y"), "rest": F.lit(0)}).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_op13_equals_brute_force(spark, tmp_path):
    rows = [r for r in ROWS if r[0] != 10] + [(1000 + i, t) for i, t in random_rows(11, 400)]
    got = queries.op13_periodic_runs(spark, write(spark, tmp_path, rows)).collect()
    want = [op13_by_hand(i, t) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_op13_of_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("n_chars < 6000").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r) for r in queries.op13_periodic_runs(spark, folder).collect()}
    assert all(got[r["doc_id"]] == op13_by_hand(r["doc_id"], r["text"]) for r in docs)
    assert sum(r[1] > 0 for r in got.values()) > 5


def test_runs_of_edge_rows(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("start", F.lit(1))
    Work(spark)
    out = df.select("doc_id", "start", runs.periodic_runs(F.col("text")).alias("r")).select("doc_id", "r.*").collect()
    by_id = {r["doc_id"]: r for r in out if r["doc_id"] is not None}
    assert (by_id[10]["start"], by_id[10]["length"], by_id[10]["period"], by_id[10]["collapsed"]) == ([0], [60_000], [3], "a b c")
    assert by_id[2]["n_words"] == 0 and by_id[2]["collapsed"] == "" and by_id[2]["start"] == []
    assert by_id[9]["n_words"] == 6 and by_id[9]["length"] == []
    assert df.filter("false").select(runs.periodic_runs(F.col("text")).alias("r")).count() == 0
    with pytest.raises(ValueError):
        runs.periodic_runs(F.col("text"), 4, 2)


# Quality rules.


def measures_by_hand(text):
    text, w = text or "", words_of(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(3)}
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_letters": sum(c.isalpha() for c in text),
        "n_upper": sum(c.isupper() for c in text),
        "n_lower": sum(c.islower() for c in text),
    }


def test_measures_equal_brute_force(spark):
    rows = [r for r in ROWS if r[0] != 11] + [(1000 + i, t) for i, t in random_rows(4, 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_words", F.lit("clash"))
    got = quality.ledger(df).drop(quality.FAILED).collect()
    want = [(i, *measures_by_hand(t).values()) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_failed_rules_policies_and_ablations(spark):
    rows = [(1, "good words here " + " ".join(f"word{i}" for i in range(60))), (2, "few"), (3, " ".join(f"w{i} $" for i in range(60))),
            (4, "same three words " * 40), (5, None), (6, " ".join(f"WORD{i}" for i in range(60)))]
    rows = spark.createDataFrame(rows, "doc_id long, text string")
    led = quality.ledger(rows)
    codes = {r["doc_id"]: r["codes"] for r in led.select("doc_id", quality.failed_rules().alias("codes")).collect()}
    assert codes[1] == [] and codes[2] == ["too_few_words"] and codes[4] == ["repeated_words"]
    assert codes[3] == ["symbols", "short_words", "few_letters"] and codes[6] == ["shouting"]
    masks = {r["doc_id"]: r[quality.FAILED] for r in led.collect()}
    assert masks[3] == 0b10001100 and masks[5] == 1
    policies = [quality.BASE, quality.POLICIES["1"], quality.Policy("lenient", ("too_few_words",), most_failures=1)]
    got = {(r["version"], r["rule"]): r for r in quality.ablations(led, policies).collect()}
    assert len(got) == len(policies) * len(quality.RULES)

    def kept(policy, without=None):
        n = 0
        for found in codes.values():
            found = [c for c in found if c != without]
            barred = any(c in policy.barred_by for c in found)
            other = sum(c not in policy.barred_by for c in found)
            n += not barred and not (policy.most_failures and other > policy.most_failures)
        return n

    for policy in policies:
        for rule in quality.RULES:
            row = got[policy.version, rule.code]
            assert (row["rows"], row["kept"], row["kept_without"]) == (6, kept(policy), kept(policy, rule.code))
            assert row["failing"] == sum(rule.code in c for c in codes.values())
            assert row["failing_alone"] == sum([rule.code] == c for c in codes.values())
    empty = quality.ablations(led.filter("false"), policies).collect()
    assert len(empty) == len(got) and all(r["rows"] == r["kept"] == r["kept_without"] == 0 for r in empty)


def test_keep_good_keeps_columns_that_clash(spark):
    df = spark.createDataFrame([(1, "word " * 3, 7), (2, " ".join(f"word{i}" for i in range(60)), 8)], "doc_id long, text string, n_words int")
    df = df.withColumns({"m": F.lit(1), "fail_bits": F.lit(2)})
    out = quality.keep_good(df)
    assert out.columns == df.columns and [tuple(r) for r in out.collect()] == [tuple(df.collect()[1])]


def test_rules_and_policies_are_checked():
    with pytest.raises(ValueError):
        quality.Policy("x", ("no_such_rule",)).mask()
    with pytest.raises(ValueError):
        quality.fail_bits([quality.Rule(f"r{i}", "true") for i in range(64)])
    assert [r.code for r in quality.RULES[:2]] == ["too_few_words", "repeated_words"]


def test_ledger_runs_without_python_and_without_shuffle(spark):
    plan = queries.op12_quality_rules(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


# Spelling variants.


def near_by_hand(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[p + 1 :] == b[p + 1 :] or a[p:] == b[p + 1 :] or a[p + 1 :] == b[p:]


def variants_by_hand(count):
    near = {w: [v for v in count if near_by_hand(w, v)] for w in count}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-count[v], v), default=None)
        if best is not None and count[best] >= 2 * count[w]:
            form[w] = best
    out = []
    for w in count:
        root = w
        while root in form:
            root = form[root]
        out.append((w, count[w], len(near[w]), form.get(w), count[form[w]] if w in form else None, root))
    return sorted(out)


def vocabulary(seed, n, letters="abß", most=9):
    rnd = random.Random(seed)
    return {"".join(rnd.choice(letters) for _ in range(rnd.randint(1, most))): rnd.choice([1, 2, 3, 3, 10, 50, 400]) for _ in range(n)}


@pytest.mark.parametrize("most_held", [1024, 4])
def test_variants_equal_brute_force(spark, most_held):
    for seed, letters in ((1, "ab"), (2, "abcdé"), (3, "中ab𝒳")):
        count = vocabulary(seed, 400, letters)
        df = spark.createDataFrame([*count.items(), (None, 5)], "word string, n long").withColumn("bucket", F.lit(1))
        got = spelling.variants(Work(spark), df, most_held=most_held).collect()
        assert sorted(map(tuple, got)) == variants_by_hand(count)


def test_blocks_of_long_and_many_words_are_compared_whole(spark):
    long = "ab" * 20_000
    count = {long: 9, long[:30_000] + long[30_001:]: 3, long[:-1] + "x": 4, long + "y": 2, **{f"shared{i:04d}": 3 + i % 5 for i in range(3000)}}
    df = spark.createDataFrame(list(count.items()), "word string, n long").repartition(1)
    got = {r["word"]: tuple(r) for r in spelling.variants(Work(spark), df).collect()}
    assert len(got) == len(count) and got[long][2] == 3 and got[long[:-1] + "x"][3] == long
    digits = [w for w in count if w.startswith("shared")]
    assert all(got[w][2] == sum(1 for k in range(6, 10) for d in "0123456789" if d != w[k] and w[:k] + d + w[k + 1 :] in count) for w in digits[::50])


def op11_by_hand(rows):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return variants_by_hand({w: n for w, n in count.items() if len(w) >= 5 and n >= 3})


def test_op11_equals_brute_force(spark, tmp_path):
    rnd = random.Random(9)
    words = ["".join(rnd.choice("abÉé×") for _ in range(rnd.randint(4, 7))) for _ in range(300)]
    rows = [r for r in ROWS if r[0] != 12] + [(100 + i, " ".join(rnd.choices(words, k=60)) + ", 7x中") for i in range(200)]
    got = queries.op11_spelling_variants(spark, write(spark, tmp_path, rows)).collect()
    want = op11_by_hand(rows)
    assert sorted(map(tuple, got)) == want and len(want) > 200


def test_op11_of_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op11_spelling_variants(spark, folder).collect()
    assert sorted(map(tuple, got)) == op11_by_hand(docs)


def test_tasks_without_near_words(spark):
    df = spark.createDataFrame([("aaaaa", 3), ("aaaab", 3), ("bcdef", 3), ("bcxyz", 4), ("bcdyz", 5)], "word string, n long").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 61)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = spelling.variants(Work(spark), df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(map(tuple, got)) == variants_by_hand({r["word"]: r["n"] for r in df.collect()})


def test_chains_of_forms_end_at_their_root(spark):
    forms = [(f"w{i:03d}", f"w{i + 1:03d}") for i in range(100)] + [("solo", "end")]
    df = spark.createDataFrame(forms, "word string, form string")
    assert {(r["word"], r["root"]) for r in spelling.roots(Work(spark), df).collect()} == {(w, "w100") for w, _ in forms[:-1]} | {("solo", "end")}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(Work(spark), spelling.word_counts(docs, spelling.thinned)).count() == 0
    assert quality.ledger(docs).count() == 0 and quality.keep_good(docs).count() == 0

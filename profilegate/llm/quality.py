"""Quality rules as a ledger of bit masks.

Each document is measured once and each rule judged once; the ledger keeps the measurements and one bit for every rule
that fails. Policies are versioned masks over these bits: applying another policy, or asking what a policy would keep
without one of its rules, reads the ledger and never a text. Everything is DataFrame expressions on one row, without a
shuffle; ablations fold the masks, of which there are at most as many as there are combinations of rules that fail.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilegate.llm.tables import WORD, without_spaces

SYMBOL = r"[#*$%&|<>]"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_upper", "n_lower")
FAILED = "fail_bits"


@dataclass(frozen=True)
class Rule:
    """A code, and when it fails, as SQL over the measurements; the n-th rule of a list has the n-th bit, for good."""

    code: str
    fails: str


# Only ever add to the end: the position of a rule is its bit in ledgers that are already written.
RULES = (
    Rule("too_few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("short_words", "word_chars < 3 * n_words"),
    Rule("long_words", "word_chars > 10 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule("shouting", "n_upper > n_lower"),
    Rule("few_letters", "2 * n_letters < word_chars"),
)


@dataclass(frozen=True)
class Policy:
    """A version, the rules that bar a document, and the number of other failures that bars it too (0: none does)."""

    version: str
    barred_by: tuple[str, ...]
    most_failures: int = 0

    def mask(self, rules: Sequence[Rule] = RULES) -> int:
        codes = [rule.code for rule in rules]
        unknown = set(self.barred_by) - set(codes)
        if unknown:
            raise ValueError(f"policy {self.version} names unknown rules: {sorted(unknown)}")
        return sum(1 << codes.index(code) for code in set(self.barred_by))


BASE = Policy("base", ("too_few_words", "repeated_words"))
POLICIES = {
    policy.version: policy
    for policy in (
        BASE,
        Policy("1", (*BASE.barred_by, "symbols", "short_words", "long_words", "repeated_lines")),
        # Scripts without spaces have long words, so these alone bar no document any more.
        Policy("2", (*BASE.barred_by, "symbols", "repeated_lines", "shouting", "few_letters")),
    )
}
CURRENT = "2"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often and in whatever lambda it is used."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column, window: int = 3) -> Column:
    """How many words lie in windows of so many words that are found twice or more.

    Windows are sorted with their places, so copies are neighbours. In order of place, each repeated window adds the
    words that the one before it doesn't hold.
    """

    def of_sorted(rows: Column) -> Column:
        both = lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"]))
        pairs = F.zip_with(F.slice(rows, 1, F.size(rows) - 1), F.slice(rows, 2, F.size(rows) - 1), both)
        places = F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull()))))
        start = F.struct(F.lit(0).cast("long").alias("covered"), F.lit(-window).alias("last"))
        step = lambda acc, i: F.struct(
            (acc["covered"] + F.least(F.lit(window), i - acc["last"])).alias("covered"), i.alias("last")
        )
        return F.aggregate(places, start, step, lambda acc: acc["covered"])

    def of_words(w: Column) -> Column:
        at = lambda i: F.struct(F.concat_ws(" ", *[w[i + k] for k in range(window)]).alias("w"), i.alias("i"))
        rows = F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - window), at))
        return F.when(F.size(w) > window, _let(rows, of_sorted)).otherwise(F.lit(0).cast("long"))

    return _let(words, of_words)


def measured(text: Column) -> Column:
    """A struct of ``MEASURES``, all long."""
    text = F.coalesce(text, F.lit(""))

    def of_parts(parts: Column) -> Column:
        words, lines = parts["words"], parts["lines"]
        out = {
            "n_words": F.size(words),
            "word_chars": F.length(without_spaces(parts["text"])),
            "n_symbols": F.regexp_count(parts["text"], F.lit(SYMBOL)),
            "n_lines": F.size(lines),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_repeat_words": repeated_words(words),
            "n_letters": F.regexp_count(parts["text"], F.lit(r"\p{L}")),
            "n_upper": F.regexp_count(parts["text"], F.lit(r"\p{Lu}")),
            "n_lower": F.regexp_count(parts["text"], F.lit(r"\p{Ll}")),
        }
        return F.struct(*[out[name].cast("long").alias(name) for name in MEASURES])

    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    return _let(F.struct(text.alias("text"), words.alias("words"), lines.alias("lines")), of_parts)


def fail_bits(rules: Sequence[Rule] = RULES) -> Column:
    """One bit for every rule that fails, over columns of the measurements."""
    if len(rules) > 63:
        raise ValueError("a ledger holds 63 rules at most")
    bits = [F.when(F.expr(rule.fails), F.lit(1 << bit)).otherwise(F.lit(0)).cast("long") for bit, rule in enumerate(rules)]
    return functools.reduce(Column.bitwiseOR, bits, F.lit(0).cast("long"))


def ledger(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """doc_id, the measurements and ``fail_bits`` of every row of ``docs`` (doc_id, text).

    Words are separated by characters of [\\x20\\x09-\\x0D], lines by \\n; a line counts if it has a word. A null text
    counts as empty, and all measurements of an empty text are 0. Rows are judged one by one, so null and repeated ids,
    other columns and empty tables need no care.
    """
    rows = docs.select("doc_id", measured(F.col("text")).alias("m"))
    rows = rows.select("doc_id", *[F.col("m")[name].alias(name) for name in MEASURES])
    return rows.withColumn(FAILED, fail_bits(rules))


def failed(policy: Policy, rules: Sequence[Rule] = RULES, without: str | None = None) -> Column:
    """Whether a policy bars a row of a ledger; ``without`` leaves one of its rules out."""
    mask, other = policy.mask(rules), (1 << len(rules)) - 1
    if without is not None:
        bit = 1 << [rule.code for rule in rules].index(without)
        mask, other = mask & ~bit, other & ~bit
    bits = F.col(FAILED)
    barred = bits.bitwiseAND(F.lit(mask).cast("long")) != 0
    if policy.most_failures:
        rest = F.bit_count(bits.bitwiseAND(F.lit(other & ~mask).cast("long")))
        barred = barred | (rest > policy.most_failures)
    return barred


def failed_rules(rules: Sequence[Rule] = RULES) -> Column:
    """The codes of the rules that fail, in the order of their bits."""
    bits = F.col(FAILED)
    codes = [F.when(bits.bitwiseAND(F.lit(1 << bit).cast("long")) != 0, F.lit(rule.code)) for bit, rule in enumerate(rules)]
    return F.array_compact(F.array(*codes))


def ablations(rows: DataFrame, policies: Sequence[Policy], rules: Sequence[Rule] = RULES) -> DataFrame:
    """For each policy and each rule of a ledger: how many rows fail the rule, fail it alone, and are kept without it.

    Columns: version, rule, rows, kept, failing, failing_alone (of all rules), kept_without. One pass over the masks:
    they are counted first, and everything else is asked of the counts. A ledger without rows gives zeros.
    """
    counts = rows.groupBy(FAILED).agg(F.count(F.lit(1)).alias("n"))
    n, bits = F.col("n"), F.col(FAILED)
    asked = {}
    for p, policy in enumerate(policies):
        asked[f"kept_{p}"] = F.when(~failed(policy, rules), n)
        asked |= {f"kept_{p}_{r}": F.when(~failed(policy, rules, rule.code), n) for r, rule in enumerate(rules)}
    for r in range(len(rules)):
        bit = F.lit(1 << r).cast("long")
        asked[f"failing_{r}"] = F.when(bits.bitwiseAND(bit) != 0, n)
        asked[f"alone_{r}"] = F.when(bits == bit, n)
    total = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in {"rows": n, **asked}.items()])
    lines = [
        F.struct(
            F.lit(policy.version).alias("version"),
            F.lit(rule.code).alias("rule"),
            F.col("rows"),
            F.col(f"kept_{p}").alias("kept"),
            F.col(f"failing_{r}").alias("failing"),
            F.col(f"alone_{r}").alias("failing_alone"),
            F.col(f"kept_{p}_{r}").alias("kept_without"),
        )
        for p, policy in enumerate(policies)
        for r, rule in enumerate(rules)
    ]
    return total.select(F.explode(F.array(*lines)).alias("a")).select("a.*")


def keep_good(docs: DataFrame, policy: Policy = POLICIES[CURRENT], rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` that a policy keeps, with all their columns, whatever these are called."""
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), measured(F.col("text")).alias("m"))
    rows = held.select("doc", *[F.col("m")[name].alias(name) for name in MEASURES]).withColumn(FAILED, fail_bits(rules))
    return rows.filter(~failed(policy, rules)).select("doc.*")


ORACLE_SQL = """
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
places AS (
  SELECT row_number() OVER () AS k, * FROM base),
grams AS (
  SELECT k, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda j: w[j] || ' ' || w[j + 1] || ' ' || w[j + 2])) AS g
  FROM places WHERE len(w) > 3),
again AS (
  SELECT k, i, count(*) OVER (PARTITION BY k, g) AS n FROM grams),
covered AS (
  SELECT k, count(DISTINCT p) AS n_repeat_words FROM (SELECT k, unnest([i, i + 1, i + 2]) AS p FROM again WHERE n > 1) GROUP BY k),
measures AS (
  SELECT doc_id, len(w) AS n_words,
    length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    length(regexp_replace(t, '[^\\p{L}]+', '', 'g')) AS n_letters,
    length(regexp_replace(t, '[^\\p{Lu}]+', '', 'g')) AS n_upper,
    length(regexp_replace(t, '[^\\p{Ll}]+', '', 'g')) AS n_lower
  FROM places LEFT JOIN covered USING (k)),
judged AS (
  SELECT *, [n_words < 50, 100 * n_repeat_words > 50 * n_words, 10 * n_symbols > n_words, word_chars < 3 * n_words,
    word_chars > 10 * n_words, 100 * n_dup_lines > 30 * n_lines, n_upper > n_lower, 2 * n_letters < word_chars] AS fails
  FROM measures)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  fails[1] OR fails[2] AS base_failed,
  NOT (fails[1] OR fails[2] OR fails[3] OR fails[6] OR fails[7] OR fails[8]) AS kept,
  CAST(list_sum(list_transform(fails, lambda f, i: CASE WHEN f THEN 1 << (i - 1) ELSE 0 END)) AS BIGINT) AS fail_bits
FROM judged
"""

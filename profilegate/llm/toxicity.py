"""Toxic passages as maximal scoring segments of token log-odds.

Tokens are lower-cased words, told apart by their first five letters and, where those are too rare to tell, by their
first four. A token's score is its log-odds between toxic and other training texts under an informative Dirichlet
prior, kept if it lies ``LEAST_Z`` standard errors from zero, less a constant cost that makes neutral text fall. One
linear pass finds every maximal scoring segment. Segment scores are compared with the extreme-value (Gumbel)
distribution of the best segment in harmless text of the same length, the evidence of all segments beyond chance is
added up, and a logistic curve turns it into a probability.

The model is fitted on at most about ``per_class`` labelled documents of either class, chosen by a hash of the id:
two thirds for token counts, one third for calibration. It has 2^18 numbers whatever the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilegate.llm.codepoints import mix64, pieces, words
from profilegate.llm.counts import count_features
from profilegate.llm.tables import Work, give_back, id_text

STEMS = 1 << 17
PER_CLASS = 6000
PRIOR_TOKENS = 2000.0
LEAST_Z = 3.0
COST = 0.3
EULER = 0.5772156649015329
RESULT = "score double, tokens long, segments array<struct<start: long, end: long, score: double, evidence: double>>"


@dataclass
class Model:
    long_stem: np.ndarray  # score by bucket of the first five letters; nan where they say nothing
    short_stem: np.ndarray  # by bucket of the first four
    rate: float = 1.0  # of the Gumbel distribution of best segments in harmless texts
    log_k: float = 0.0
    base: float = 0.0  # logistic curve over the log of the evidence
    slope: float = 1.0


def _stems(w) -> tuple[np.ndarray, np.ndarray]:
    last = max(len(w.letters) - 1, 0)
    parts = [np.where(w.size > j, w.letters[np.minimum(w.first + j, last)], 0) for j in range(5)]
    return tuple((mix64(*parts[:n]) >> np.uint64(47)).astype(np.int64) for n in (5, 4))


def features(texts: list[str | None]) -> Iterator[np.ndarray]:
    for points, _ in pieces(texts):
        w = words(points)
        if len(w.first):
            long_stem, short_stem = _stems(w)
            yield long_stem
            yield STEMS + short_stem


def log_odds(toxic: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Log-odds with a Dirichlet prior proportional to the overall frequency; nan where they aren't significant."""
    both = toxic + other
    prior = PRIOR_TOKENS * both / max(both.sum(), 1) + 0.5
    total = prior.sum()
    one, two = toxic + prior, other + prior
    delta = np.log(one / (toxic.sum() + total - one)) - np.log(two / (other.sum() + total - two))
    z = delta / np.sqrt(1 / one + 1 / two)
    return np.where(np.abs(z) >= LEAST_Z, delta, np.nan)


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (first, last, score), in linear time; only positive scores start one.

    Each candidate is linked to the last one before it whose sum of scores up to its start is smaller. Searches follow
    these links, and none passes a candidate that an earlier search has passed.
    """
    upto = np.cumsum(scores, dtype=np.float64)
    starts = np.flatnonzero(scores > 0)
    lefts, rights = (upto[starts] - scores[starts]).tolist(), upto[starts].tolist()
    firsts: list[int] = []
    lasts: list[int] = []
    low: list[float] = []
    high: list[float] = []
    link: list[int] = []
    for i, left, right in zip(starts.tolist(), lefts, rights, strict=True):
        first, j = i, len(firsts) - 1
        while True:
            while j >= 0 and low[j] >= left:
                j = link[j]
            if j < 0 or high[j] >= right:
                break
            # One segment from that candidate's start to here, which takes the place of all since.
            first, left, before = firsts[j], low[j], link[j]
            for column in (firsts, lasts, low, high, link):
                del column[j:]
            j = before
        firsts.append(first)
        lasts.append(i)
        low.append(left)
        high.append(right)
        link.append(j)
    return [(a, b, right - left) for a, b, left, right in zip(firsts, lasts, low, high, strict=True)]


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model = model

    def token_scores(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        w = words(points)
        if not len(w.first):
            none = np.zeros(0)
            return none, none, none
        long_stem, short_stem = _stems(w)
        score = self.model.long_stem[long_stem]
        score = np.where(np.isnan(score), self.model.short_stem[short_stem], score)
        return w.at, w.at + w.size, np.nan_to_num(score, nan=0.0) - COST

    def score(self, texts: list[str | None]) -> list[tuple[float, int, list[dict]]]:
        out: list = [self.finish([])] * len(texts)
        held: list = []
        number, offset = -1, 0
        for points, marks in pieces(texts):
            at, end, score = self.token_scores(points)
            cut = np.searchsorted(at, [m[1] for m in marks] + [marks[-1][2]])
            for k, (this, start, stop) in enumerate(marks):
                if this != number:
                    if held:
                        out[number] = self.finish(held)
                    held, number, offset = [], this, 0
                own = slice(cut[k], cut[k + 1])
                if cut[k] < cut[k + 1]:
                    held.append((at[own] - start + offset, end[own] - start + offset, score[own]))
                offset += stop - start
        if held:
            out[number] = self.finish(held)
        return out

    def finish(self, held: list) -> tuple[float, int, list[dict]]:
        m = self.model
        segments, total, n = [], 0.0, 0
        if held:
            at, end, score = held[0] if len(held) == 1 else [np.concatenate(x) for x in zip(*held, strict=True)]
            n = len(at)
            chance = m.log_k + np.log(n)
            for a, b, value in maximal_segments(score):
                evidence = max(0.0, m.rate * value - chance)
                total += evidence
                segments.append({"start": int(at[a]), "end": int(end[b]), "score": value, "evidence": evidence})
        p = 1 / (1 + np.exp(-np.clip(m.base + m.slope * np.log1p(total), -30, 30)))
        return float(p), n, segments


def calibrate(model: Model, sample: list[tuple[bool, int, list[float]]], share: float) -> Model:
    """Fit the extreme values of harmless texts and the logistic curve; ``share`` of all labelled texts is toxic."""
    texts = [(toxic, np.log(n), np.array(found)) for toxic, n, found in sample if n]
    best = np.array([found.max(initial=0.0) for toxic, _, found in texts if not toxic])
    size = np.array([n for toxic, n, _ in texts if not toxic])
    if len(best) > 10:
        spread = max(float(best.var()), 1e-6)
        model.rate = float(np.clip(np.sqrt((np.pi**2 / 6 + size.var()) / spread), 1.0, 8.0))
        model.log_k = float(model.rate * best.mean() - EULER - size.mean())
    x = np.array([np.log1p(np.maximum(0, model.rate * found - model.log_k - n).sum()) for _, n, found in texts])
    y = np.array([toxic for toxic, _, _ in texts], float)
    if not 0 < y.sum() < len(y):
        model.base, model.slope = np.log((share + 1e-6) / (1 - share + 1e-6)), 0.0
        return model
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    design, beta, pull = np.stack([np.ones_like(x), x], 1), np.zeros(2), np.diag([0.01, 0.01])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weight * (y - p)) - pull @ beta
        step = np.linalg.solve((design.T * (weight * p * (1 - p))) @ design + pull, slope)
        beta += np.clip(step, -1, 1)
    model.base, model.slope = float(beta[0]), float(beta[1])
    return model


def sample(work: Work, docs: DataFrame, labels: DataFrame, per_class: int) -> tuple[DataFrame, float]:
    """About ``per_class`` labelled texts of either class, and the toxic share of all labels."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    u = F.conv(F.substring(F.md5(F.concat(F.lit("toxicity:"), id_text(F.col("doc_id"))).cast("binary")), 1, 8), 16, 10)
    limit = F.when(F.col("toxic") == 1, per_class / max(totals.get(1, 0), 1)).otherwise(per_class / max(totals.get(0, 0), 1))
    chosen = work.land(known.filter(u.cast("double") < F.lit(float(2**32)) * limit), "labels")
    texts = docs.filter("text IS NOT NULL").select("doc_id", "text").join(chosen, "doc_id")
    n = sum(totals.values())
    return work.land(texts, "labelled"), totals.get(1, 0) / n if n else 0.0


def fit(work: Work, docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """``docs`` has doc_id and text; ``labels`` has doc_id and toxic (0 or 1, other values teach nothing)."""
    labelled, share = sample(work, docs, labels, per_class)
    calibrating = F.crc32(F.concat(F.lit("part:"), id_text(F.col("doc_id"))).cast("binary")) % 3 == 0
    counts = count_features(labelled.filter(~calibrating).select(F.col("toxic").cast("string").alias("class"), "text"), features, 2 * STEMS)
    toxic, other = (counts.get(k, np.zeros(2 * STEMS, np.int64)).astype(float) for k in ("1", "0"))
    model = Model(log_odds(toxic[:STEMS], other[:STEMS]), log_odds(toxic[STEMS:], other[STEMS:]))
    scored = labelled.filter(calibrating).select("toxic", toxicity(work, model, F.col("text")).alias("t"))
    rows = scored.select("toxic", "t.tokens", F.expr("transform(t.segments, s -> s.score)").alias("found")).collect()
    return calibrate(model, [(r["toxic"] == 1, r["tokens"], list(r["found"])) for r in rows], share)


def toxicity(work: Work, model: Model, text: Column) -> Column:
    """A struct column: score from 0 to 1, number of tokens, and every maximal segment with its evidence.

    Null and empty texts and texts without letters have no segments and the score of a text without evidence.
    Segments are code point offsets of first and last token; texts of any length are read whole.
    """
    shared = work.spark.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for batch in batches:
            yield pd.DataFrame(scorer.score(batch.tolist()), columns=["score", "tokens", "segments"])
        give_back()

    return scored(text)

"""Language identification by spans.

A model holds log probabilities of hashed letter trigrams by language and the scripts each language is written
in. In a text, every word is scored under the languages its script admits, and a Viterbi pass with a penalty for
each switch labels the words; neighbouring words of one label are a span. The text's language is the one whose
spans hold most letters. Its score is their share of the letters in spans, and ``share`` that of all letters, those of
scripts that no language is written in included.

The model is fitted on at most about ``per_language`` documents of each language, chosen by a hash of their id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilegate.llm.codepoints import SCRIPTS, mix64, pieces, tables, words
from profilegate.llm.counts import count_features
from profilegate.llm.tables import Work, give_back, id_text

UNKNOWN = "und"
TRIGRAMS = 1 << 15
BUCKETS = TRIGRAMS + 1024  # the last ones count letters by script
PER_LANGUAGE = 2000
PENALTY = 12.0
LEAST_SHARE = 0.002
NOT_ITS_SCRIPT = -40.0
RESULT = "lang_pred string, score double, share double, spans array<struct<start: long, end: long, lang: string>>"


@dataclass
class Model:
    languages: list[str]
    logp: np.ndarray  # trigram bucket x language
    admits: np.ndarray  # script x language
    prior: np.ndarray  # log share of the training letters


def _trigrams(w) -> np.ndarray:
    return (mix64(w.before, w.letters, w.after) >> np.uint64(49)).astype(np.int64)


def features(texts: list[str | None]) -> Iterator[np.ndarray]:
    for points, _ in pieces(texts):
        w = words(points)
        yield _trigrams(w)
        yield TRIGRAMS + tables()[2][w.letters].astype(np.int64)


def sample(work: Work, docs: DataFrame, per_language: int) -> DataFrame:
    """About ``per_language`` documents of each language as class and text, the same ones on every run."""
    known = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", F.col("lang").alias("class"))
    totals = known.groupBy("class").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("class", "of")
    totals = work.land(totals, "languages")  # one row per language, so Spark knows that it is small
    u = F.conv(F.substring(F.md5(F.concat(F.lit("language:"), id_text(F.col("doc_id"))).cast("binary")), 1, 8), 16, 10)
    known = known.join(totals, F.col("class") == F.col("of"))
    return known.filter(u.cast("double") * F.col("n") < F.lit(float(2**32)) * per_language).select("class", "text")


def fit(work: Work, docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """``docs`` has doc_id, text and lang; rows without text or language teach nothing."""
    counts = count_features(work.land(sample(work, docs, per_language), "language-sample"), features, BUCKETS)
    languages = list(counts)
    if not languages:
        return Model([], np.zeros((TRIGRAMS, 0), np.float32), np.zeros((len(SCRIPTS), 0), bool), np.zeros(0))
    table = np.stack([counts[x] for x in languages], axis=1).astype(float)
    grams, scripts = table[:TRIGRAMS], table[TRIGRAMS : TRIGRAMS + len(SCRIPTS)]
    # Smoothed towards the trigram's frequency over all languages.
    common = (grams.sum(1, keepdims=True) + 0.05) / (grams.sum() + 0.05 * TRIGRAMS)
    logp = np.log((grams + 200 * common) / (grams.sum(0) + 200))
    share = scripts / np.maximum(scripts.sum(0), 1)
    prior = np.log((scripts.sum(0) + 1) / (scripts.sum() + len(languages)))
    return Model(languages, logp.astype(np.float32), share >= LEAST_SHARE, prior)


def viterbi(scores: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each row of ``scores``, a change of label costing ``penalty``; ties stay, then go to the first."""
    n = scores.shape[1]
    rows = scores.tolist()
    value = list(rows[0])
    back = []
    for row in rows[1:]:
        top = max(value)
        best = value.index(top)
        enter = top - penalty
        back.append([j if value[j] >= enter else best for j in range(n)])
        value = [(value[j] if value[j] >= enter else enter) + row[j] for j in range(n)]
    state = value.index(max(value))
    path = [state]
    for step in reversed(back):
        state = step[state]
        path.append(state)
    return np.array(path[::-1])


def decode(scores: np.ndarray, penalty: float) -> np.ndarray:
    """``viterbi``, without the pass where one label is certainly best.

    If no stretch of words gains more than one penalty by leaving the label with the best total, no path that
    switches can be better than staying.
    """
    best = int(np.argmax(scores.sum(0, dtype=np.float64)))
    if scores.shape[1] == 1:
        return np.zeros(len(scores), np.int64)
    gain = np.delete(scores, best, axis=1).max(1).astype(np.float64) - scores[:, best]
    run = np.concatenate([[0.0], np.cumsum(gain)])
    if (run[1:] - np.minimum.accumulate(run)[:-1]).max() < penalty:
        return np.full(len(scores), best)
    return viterbi(scores.astype(np.float64), penalty)


class Labeller:
    def __init__(self, model: Model, penalty: float = PENALTY) -> None:
        self.model, self.penalty = model, penalty

    def word_scores(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Offset, end, letters and scores of each word."""
        w = words(points)
        if not len(w.first):
            none = np.zeros(0, np.int64)
            return none, none, none, np.zeros((0, len(self.model.languages)), np.float32)
        scores = np.add.reduceat(self.model.logp[_trigrams(w)], w.first, axis=0)
        admits = self.model.admits[tables()[2][w.letters[w.first]]]
        narrowed = admits.any(1)
        scores[narrowed] += np.where(admits[narrowed], np.float32(0), np.float32(NOT_ITS_SCRIPT))
        scores[~narrowed] = 0
        return w.at, w.at + w.size, w.size, scores

    def label(self, texts: list[str | None]) -> list[tuple[str, float, float, list[dict]]]:
        out: list = [(UNKNOWN, 0.0, 0.0, [])] * len(texts)
        if not self.model.languages:
            return out
        held: list = []
        number, offset = -1, 0
        for points, marks in pieces(texts):
            at, end, size, scores = self.word_scores(points)
            cut = np.searchsorted(at, [m[1] for m in marks] + [marks[-1][2]])
            for k, (this, start, stop) in enumerate(marks):
                if this != number:
                    if held:
                        out[number] = self.finish(held)
                    held, number, offset = [], this, 0
                own = slice(cut[k], cut[k + 1])
                if cut[k] < cut[k + 1]:
                    held.append((at[own] - start + offset, end[own] - start + offset, size[own], scores[own]))
                offset += stop - start
        if held:
            out[number] = self.finish(held)
        return out

    def finish(self, held: list) -> tuple[str, float, float, list[dict]]:
        at, end, size, scores = held[0] if len(held) == 1 else [np.concatenate(x) for x in zip(*held, strict=True)]
        names = self.model.languages
        known = scores.any(1)
        if not known.any():
            return names[int(np.argmax(self.model.prior))], 0.0, 0.0, []
        letters_in_all = int(size.sum())
        at, end, size, scores = at[known], end[known], size[known], scores[known]
        path = decode(scores, self.penalty)
        letters = np.bincount(path, size, len(names))
        best = int(np.argmax(letters))
        turn = np.flatnonzero(np.append(True, path[1:] != path[:-1]))
        last = np.append(turn[1:], len(path)) - 1
        spans = [{"start": int(at[i]), "end": int(end[j]), "lang": names[path[i]]} for i, j in zip(turn, last, strict=True)]
        return names[best], float(letters[best] / letters.sum()), float(letters[best] / letters_in_all), spans


def label(work: Work, model: Model, text: Column, penalty: float = PENALTY) -> Column:
    """A struct column: lang_pred, score, share, and the spans of the text by code point offsets.

    Null texts and texts without a letter are ``und`` with score and share 0 and no spans, and so is everything under a
    model that has learned nothing. Letters of scripts that no language is written in have no span; a text with
    no others gets the commonest language with score 0. Equal totals go to the language first by name.
    """
    shared = work.spark.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def labelled(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        labeller = Labeller(shared.value, penalty)
        for batch in batches:
            yield pd.DataFrame(labeller.label(batch.tolist()), columns=["lang_pred", "score", "share", "spans"])
        give_back()

    return labelled(text)

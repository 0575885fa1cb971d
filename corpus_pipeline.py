"""A training corpus from raw documents, as stages that each read what the one before has written.

Language identification, exact and near-duplicates, mixing of sources, and packing into sequences. Every stage takes
all rows its predecessor kept; all but the last return the columns of the documents they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profilegate.llm import dedup, langid, mixing, neardup, packing
from profilegate.llm.tables import Work, fresh, read


#: The least share of a text's letters that the spans of its language must hold. Texts that mix four languages evenly stay.
LEAST_SHARE = 0.25


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language was found, learned from the labels of the same documents.

    Null and empty texts and texts without a letter go, and so do texts of whose letters no language's spans hold
    ``LEAST_SHARE``, such as those in scripts that no labelled document is written in. All others stay, and a missing lang
    is filled with the language found. Without any label nothing can be learned or rejected for its language: texts with a
    letter stay as they are.
    """
    work = Work(spark)
    model = langid.fit(work, docs)
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    (found,) = fresh(docs, "found")
    # Behind a generator of one row for each row, so that the filter doesn't label the texts a second time.
    labelled = docs.withColumn(found, langid.label(work, model, F.col("text"))).withColumn(found, F.explode(F.array(found)))
    known = labelled.filter((F.col(found)["lang_pred"] != langid.UNKNOWN) & (F.col(found)["share"] >= LEAST_SHARE))
    return known.withColumn("lang", F.coalesce("lang", F.col(found)["lang_pred"])).select(*[F.col(f"`{c}`") for c in docs.columns])


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with equal texts."""
    return dedup.without_duplicates(Work(spark), docs)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates, at 80 % of five-word shingles."""
    return neardup.without_near_duplicates(Work(spark), docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, once for each copy."""
    used = {"doc_id", "text", "source"}
    inner = {c: c if c in used else f"other_{i}" for i, c in enumerate(docs.columns)}
    mixed = mixing.mix(Work(spark), docs.select(*[F.col(f"`{c}`").alias(name) for c, name in inner.items()]))
    copies = mixed.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return copies.select(*[F.col(name).alias(c) for c, name in inner.items()])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in sequences of 2048 tokens."""
    return packing.pack_documents(Work(spark), docs.select("doc_id", "text"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("minhash_dedup", minhash_dedup),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

# Neither the learned language model nor the tokenizer can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    work = Work(spark)
    for position, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if position + 1 < len(STAGES):
            docs = work.land(docs, name)
    return docs

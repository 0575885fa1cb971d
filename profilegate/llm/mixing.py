"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target number of words: its weighted share of all words, at most ``max_copies`` times
what it holds, the excess going to the others by weight. Every document of a source is taken
``floor(target / held)`` whole times. The rest is a sample without replacement in which every document has
the inclusion odds p / (1 - p), p being the missing fraction: documents are ranked by random odds
u / (1 - u) over inclusion odds and taken in that order until the missing words are reached. The size is
fixed in words, so a source misses its target by half of its last document at most.

No source is ordered as a whole. Ranks fall into fixed cells, words are summed per cell before any shuffle,
and only the cell that holds the cut is ordered. The cut, one row per source, then decides every document
where it is read. Randomness is a hash of the seed and the document id, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from profilegate.llm.tables import Work, fresh, id_text, word_count

HALF_CELLS = 8192
_NO_ID = -(2**63)

# One text for Spark and for the checking engine. {sized} has source and size.
TARGET_SQL = """
WITH per_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS t FROM {sized} GROUP BY source),
weighted AS (SELECT source, t, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM per_source),
ordered AS (
  SELECT source, t, w, CAST(sum(t) OVER () AS BIGINT) AS total,
    CAST(coalesce(sum(t) OVER (ORDER BY CAST(t AS DOUBLE) / w, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before,
    CAST(sum(w) OVER (ORDER BY CAST(t AS DOUBLE) / w, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS rest
  FROM weighted),
capped AS (
  SELECT *, CAST(total - {copies} * before AS DECIMAL(20, 0)) * CAST(w AS DECIMAL(12, 0))
    >= CAST({copies} * t AS DECIMAL(20, 0)) * CAST(rest AS DECIMAL(12, 0)) AS full_up
  FROM ordered),
shared AS (
  SELECT *, CAST(coalesce(sum(CASE WHEN full_up THEN t END) OVER (), 0) AS BIGINT) AS full_words,
    CAST(coalesce(sum(CASE WHEN NOT full_up THEN w END) OVER (), 0) AS BIGINT) AS open_weight
  FROM capped),
targets AS (
  SELECT source, t AS source_size,
    CASE WHEN full_up THEN CAST({copies} * t AS DOUBLE)
      ELSE CAST(w * (total - {copies} * full_words) AS DOUBLE) / CAST(open_weight AS DOUBLE) END AS target
  FROM shared),
wholes AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / CAST(source_size AS DOUBLE)) AS BIGINT) ELSE 0 END AS whole
  FROM targets),
missing AS (
  SELECT *, target - CAST(whole * source_size AS DOUBLE) AS missing FROM wholes)
SELECT source, source_size, target, whole, missing,
  CASE WHEN source_size > 0 AND missing > 0 AND missing < source_size
    THEN (missing / CAST(source_size AS DOUBLE)) / (1 - missing / CAST(source_size AS DOUBLE)) END AS odds
FROM missing
"""


def random_odds(doc_id: Column, seed: int) -> Column:
    """u / (1 - u) for u = (h + 1/2) / 2^52, h being the first 52 bits of the MD5 of ``seed:doc_id``."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), id_text(doc_id)).cast("binary")), 1, 13)
    u = (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**52))
    return u / (F.lit(1.0) - u)


def _cell(rank: Column) -> Column:
    """Cells that grow with the rank, as many below 1 as above; one rounded division keeps the order."""
    low = F.floor(rank * HALF_CELLS)
    high = 2 * HALF_CELLS - 1 - F.ceil(F.lit(float(HALF_CELLS)) / rank) + F.lit(1)
    return F.when(rank < 1, low).otherwise(F.greatest(F.lit(HALF_CELLS).cast("long"), high))


def _ranked(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Documents with what their source's plan says, their rank, and an id that orders."""
    plan = plan.withColumnRenamed("source", "plan_source")
    out = sized.join(plan, F.col("source").eqNullSafe(F.col("plan_source")), "left").drop("plan_source")
    return out.withColumn("rank", F.col("mix_odds") / F.col("odds")).withColumn("cell", _cell(F.col("rank")))


def sampling_plan(work: Work, sized: DataFrame, max_copies: int = 3) -> DataFrame:
    """One row per source: target, whole copies, and the rank and id of the last document sampled."""
    spark = work.spark
    sized.createOrReplaceTempView("profilegate_mix_sized")
    try:
        targets = work.land(spark.sql(TARGET_SQL.format(sized="profilegate_mix_sized", copies=max_copies)), "targets")
    finally:
        spark.catalog.dropTempView("profilegate_mix_sized")
    ranked = _ranked(sized, targets).filter("rank IS NOT NULL")
    cells = ranked.groupBy("source", "cell").agg(F.sum("size").alias("words"), F.first("missing").alias("missing"))
    upto = Window.partitionBy("source").orderBy("cell")
    cells = cells.withColumn("before", F.sum("words").over(upto) - F.col("words"))
    cut = cells.filter("before <= missing AND missing < before + words")
    cut = work.land(cut.select(F.col("source").alias("cut_source"), F.col("cell").alias("cut_cell"), "before"), "cells")
    inside = ranked.join(cut, F.col("source").eqNullSafe(F.col("cut_source")) & (F.col("cell") == F.col("cut_cell")))
    inside = inside.groupBy("source", "rank", "mix_id").agg(
        F.sum("size").alias("words"), F.first("missing").alias("missing"), F.first("before").alias("before")
    )
    order = Window.partitionBy("source").orderBy("rank", "mix_id")
    start = F.col("before") + F.sum("words").over(order) - F.col("words")
    inside = inside.withColumn("taken", start + F.col("words") / 2 <= F.col("missing")).filter("taken")
    last = inside.groupBy("source").agg(F.max(F.struct("rank", "mix_id")).alias("last"))
    last = last.select(F.col("source").alias("last_source"), "last")
    out = targets.join(cut, F.col("source").eqNullSafe(F.col("cut_source")), "left")
    out = out.join(last, F.col("source").eqNullSafe(F.col("last_source")), "left")
    return work.land(out.select(*targets.columns, "cut_cell", "last"), "plan")


def sized(docs: DataFrame, seed: int = 7) -> DataFrame:
    """Documents with the words they hold (null text: 0) and the random odds of their id."""
    return docs.withColumns(
        {
            "size": word_count(F.col("text")),
            "mix_id": F.coalesce(F.col("doc_id"), F.lit(_NO_ID)),
            "mix_odds": random_odds(F.col("doc_id"), seed),
        }
    )


def apply_plan(sized_docs: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds ``source_size``, ``target`` and ``copies`` to each document."""
    out = _ranked(sized_docs, plan)
    sampled = (F.col("cell") < F.col("cut_cell")) | (
        (F.col("cell") == F.col("cut_cell")) & (F.struct("rank", "mix_id") <= F.col("last"))
    )
    copies = F.col("whole") + F.coalesce(sampled, F.lit(False)).cast("long")
    return out.withColumn("copies", copies).drop("rank", "cell", "whole", "missing", "odds", "cut_cell", "last", "mix_id", "mix_odds")


def mix(work: Work, docs: DataFrame, seed: int = 7, max_copies: int = 3) -> DataFrame:
    """Documents with ``size``, ``source_size``, ``target`` and the number of ``copies`` the mix takes.

    ``docs`` has doc_id (long), text and source; other columns stay as they are, whatever they are called. The four that are
    added have underscores after their names where ``docs`` has a column so named. Rows of one source that share a doc_id
    stand or fall together. A null id counts as the smallest one, a null source is a source of its own, null and empty
    texts hold no words and have copies like any other. An empty table gives an empty one.
    """
    used = ("doc_id", "text", "source")
    others = [c for c in docs.columns if c.lower() not in used]
    held = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(None)
    kept = docs.select(*used, held.alias("held"))
    rows = work.land(sized(kept.select(*used), seed).drop("text"), "sizes")
    out = apply_plan(sized(kept, seed), sampling_plan(work, rows, max_copies))
    added = ("size", "source_size", "target", "copies")
    columns = [F.col("held")[c].alias(c) if c in others else F.col(c) for c in docs.columns]
    return out.select(*columns, *[F.col(c).alias(name) for c, name in zip(added, fresh(docs, *added), strict=True)])


def mix_sizes(work: Work, docs: DataFrame, seed: int = 7, max_copies: int = 3) -> DataFrame:
    """The same decisions as ``mix`` without texts: doc_id, source, size, source_size, target, copies."""
    rows = work.land(sized(docs.select("doc_id", "text", "source"), seed).drop("text"), "sizes")
    return apply_plan(rows, sampling_plan(work, rows, max_copies))


ORACLE_SQL = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
    coalesce(doc_id, -9223372036854775808) AS mix_id,
    (CAST('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5::DOUBLE)
      / 4503599627370496.0::DOUBLE AS u
  FROM documents),
plan AS ({targets}),
ranked AS (
  SELECT d.*, p.source_size, p.target, p.whole, p.missing, (u / (1.0::DOUBLE - u)) / p.odds AS rank
  FROM sized d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source),
summed AS (
  SELECT *,
    sum(size) OVER (PARTITION BY source, rank IS NULL ORDER BY rank, mix_id RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
    sum(size) OVER (PARTITION BY source, rank, mix_id) AS own
  FROM ranked)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
  CAST(size * (whole + CASE WHEN rank IS NOT NULL AND upto - own + own / 2.0::DOUBLE <= missing THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM summed
"""


def oracle(max_copies: int = 3) -> str:
    return ORACLE_SQL.format(targets=TARGET_SQL.format(sized="sized", copies=max_copies))

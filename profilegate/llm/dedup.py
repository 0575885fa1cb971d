"""Exact deduplication of incoming documents against immutable snapshots.

A snapshot is a table of digests, one row per distinct normalised text, with a static binary-fuse filter for every
bucket of digests. Incoming documents are first grouped among themselves by digest. The filters then screen the groups
bucket by bucket; only positives join the snapshot's exact rows. Texts are compared byte by byte wherever more than one
row shares a digest, so a group is a group of equal texts even if digests collide.

Bytes are compared without gathering a group: each task keeps the least and the greatest text it sees of a digest, and
a digest whose least and greatest texts differ stands for several. Rows that can't belong to a group are left out of
this by a second set of filters over the shared digests, unless that is too large to send to every task; then all rows
are compared.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilegate.llm import fuse
from profilegate.llm.screening import bucket_count, filter_table, screened, without
from profilegate.llm.tables import Work, fresh, without_spaces

_SCREENED = "key string, n_points long, doc_id long, size long, hit boolean"


def normalised(text: Column) -> Column:
    return without_spaces(F.coalesce(text, F.lit("")))


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def digests(docs: DataFrame, digest=sha256) -> DataFrame:
    """doc_id, key (digest of the normalised text) and n_points (code points of the original text)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", digest(normalised(F.col("text"))).alias("key"), F.length(text).cast("long").alias("n_points"))


def _short(key: Column) -> Column:
    return F.xxhash64(key)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.hash(_short(F.col("key"))), F.lit(buckets))


def grouped(rows: DataFrame) -> DataFrame:
    """One row per key: its size, and the row that stays (most code points, then least doc_id, a null id last)."""
    best = F.min(F.struct((-F.col("n_points")).alias("less"), F.col("doc_id").isNull().alias("none"), "doc_id"))
    out = rows.groupBy("key").agg(F.sum("size").alias("size"), best.alias("best"))
    return out.select("key", (-F.col("best.less")).alias("n_points"), F.col("best.doc_id").alias("doc_id"), "size")


def screen(incoming: DataFrame, snapshot_filters: DataFrame, buckets: int) -> DataFrame:
    """Adds ``hit``: whether a key may be in the snapshot. A bucket without filter has no hits."""

    def probe(rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        hit = np.zeros(len(rows), bool)
        for one in found["filter"]:
            hit |= fuse.probe(one, rows["short"].to_numpy())
        return rows.assign(hit=hit)[["key", "n_points", "doc_id", "size", "hit"]]

    rows = incoming.withColumns({"bucket": _bucket(buckets), "short": _short(F.col("key"))})
    return rows.groupBy("bucket").cogroup(snapshot_filters.groupBy("bucket")).applyInPandas(probe, _SCREENED)


def merge(work: Work, snapshot: DataFrame, batch: DataFrame, buckets: int) -> DataFrame:
    """Groups over a snapshot's rows and a batch's, both grouped: screened, then joined exactly where positive."""
    built = filter_table(snapshot.select(_short(F.col("key")).alias("key")), buckets)
    probed = work.land(screen(batch, built, buckets), "screened")
    positive = probed.filter("hit").drop("hit")
    old = snapshot.join(positive.select("key"), "key", "left_semi")
    both = grouped(old.unionByName(positive))
    untouched = snapshot.join(positive.select("key"), "key", "left_anti")
    return both.unionByName(untouched).unionByName(probed.filter("NOT hit").drop("hit"))


def clashing(work: Work, docs: DataFrame, groups: DataFrame, digest=sha256) -> DataFrame:
    """Keys that stand for more than one text."""
    shared = groups.filter("size > 1").select(_short(F.col("key")).alias("key"))
    rows = docs.select(normalised(F.col("text")).alias("norm")).withColumn("key", digest(F.col("norm")))
    rows = screened(work, rows, _short(F.col("key")), shared)
    ends = rows.groupBy("key").agg(F.min("norm").alias("least"), F.max("norm").alias("greatest"))
    return ends.filter("least != greatest").select("key")


def exact_groups(work: Work, docs: DataFrame, digest=sha256) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, key, n_points) and groups (key, n_points, doc_id, size) of ``docs`` (doc_id, text).

    Half of the documents, by a hash of their id, are the snapshot and the other half the batch that comes in.
    """
    rows = work.land(digests(docs, digest), "digests")
    half = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(2)) == 0
    one = rows.withColumn("size", F.lit(1).cast("long"))
    snapshot = work.land(grouped(one.filter(half)), "snapshot")
    batch = work.land(grouped(one.filter(~half)), "batch")
    buckets = bucket_count(snapshot)
    groups = work.land(merge(work, snapshot, batch, buckets), "groups")
    clashes = work.land(clashing(work, docs, groups, digest), "clashes")
    if not clashes.isEmpty():
        rows = work.land(_with_bytes(docs, clashes, digest), "exact-digests")
        groups = work.land(grouped(rows.withColumn("size", F.lit(1).cast("long"))), "exact-groups")
    return rows, groups


def _with_bytes(docs: DataFrame, clashes: DataFrame, digest) -> DataFrame:
    """Rows whose key is followed by the text itself where a digest alone can't tell."""
    clash = clashes.withColumnRenamed("key", "clash")
    full = docs.select("doc_id", F.col("text"), normalised(F.col("text")).alias("norm")).withColumn("digest", digest(F.col("norm")))
    full = full.join(clash, F.col("digest") == F.col("clash"), "left")
    key = F.concat("digest", F.when(F.col("clash").isNotNull(), F.concat(F.lit(":"), "norm")).otherwise(F.lit("")))
    return full.select("doc_id", key.alias("key"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_points"))


def exact_duplicates(work: Work, docs: DataFrame, digest=sha256) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, digest.

    ``docs`` has doc_id (long) and text. A null text counts as empty; empty texts and texts of white space alone are equal
    to each other. A null doc_id never stays where the group has another. Of rows that repeat both doc_id and text, all
    are counted and share ``kept``: they are one document; ``without_duplicates`` keeps one of them.
    """
    rows, groups = exact_groups(work, docs, digest)
    best = groups.select(F.col("key").alias("group_key"), F.col("doc_id").alias("keep_id"), "size")
    out = rows.join(best, F.col("key") == F.col("group_key"))
    return out.select(
        "doc_id",
        "keep_id",
        F.col("size").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.substring_index("key", ":", 1).alias("digest"),
    )


def without_duplicates(work: Work, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns; of rows repeating doc_id and text, one."""
    rows, groups = exact_groups(work, docs.select("doc_id", "text"))
    stay = groups.select(F.col("key").alias("group_key"), F.col("doc_id").alias("stay_id"))
    gone = rows.join(stay, F.col("key") == F.col("group_key")).filter("NOT doc_id <=> stay_id")
    gone_id, gone_key = fresh(docs, "gone_id", "gone_key")
    gone = work.land(gone.select(F.col("doc_id").alias(gone_id), F.col("key").alias(gone_key)).distinct(), "gone")
    key = sha256(normalised(F.col("text")))
    match = F.col("doc_id").eqNullSafe(F.col(gone_id)) & F.col(gone_key).startswith(key)
    # A null id has no place among longs; the hash of an id has.
    out = without(work, docs, F.xxhash64("doc_id"), gone, F.xxhash64(gone_id), match)
    if not rows.groupBy("key", "doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        out = out.withColumn(gone_key, key).dropDuplicates(["doc_id", gone_key]).drop(gone_key)
    return out


ORACLE_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g') AS norm FROM documents),
g AS (
  SELECT norm, count(*) AS group_size,
    (list(doc_id ORDER BY length(text) DESC, doc_id NULLS LAST))[1] AS keep_id
  FROM d GROUP BY norm)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g ON d.norm = g.norm
"""

"""Near-duplicates by circulant MinHash, banding, and exact Jaccard verification.

1. Every text becomes the set of its word shingles. Texts with equal sets are folded into one node.
2. Nodes that share a band of their signature meet in a bucket. Two nodes at the threshold miss each other in all of
   the ``BANDS`` bands of ``ROWS`` coordinates with probability (1 - 0.8^6)^36, about 2 in 100,000.
3. In each bucket, every node is compared with one leader, the node that shares buckets with most others, on full sets.
   That takes one comparison per bucket and node, and components follow from the links.
4. In buckets that still hold several components, every two nodes of different components are compared, block against
   block inside tasks; only links leave them.

Nothing is capped and no table of pairs is made: rows grow with a bucket's size, times its number of blocks in step 4.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilegate.llm.components import components
from profilegate.llm.screening import screened, without
from profilegate.llm.shingles import bands, set_key, shingle_set, signature
from profilegate.llm.tables import Work, fresh, give_back

WORDS = 5
PERCENT = 80
ROWS = 6
BANDS = 36
BLOCK = 256
BLOCK_SHINGLES = 1 << 20
COLUMNS = 4096


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n (size of the shingle set), set_key and bands, both null without shingles."""

    @F.pandas_udf("n long, set_key string, bands array<long>")
    def signed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch.tolist():
                found = shingle_set(text, words)
                if len(found):
                    out.append((len(found), set_key(found), bands(signature(found, ROWS * BANDS), ROWS)))
                else:
                    out.append((0, None, None))
            yield pd.DataFrame(out, columns=["n", "set_key", "bands"])
        give_back()

    return docs.select("doc_id", signed("text").alias("s")).select("doc_id", "s.n", "s.set_key", "s.bands")


def shingles_of(work: Work, docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """node and its sorted set, for the texts of ``nodes`` (node, set_key)."""

    @F.pandas_udf("array<long>")
    def found(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, keys in batches:
            sets = (shingle_set(x, words) for x in texts.tolist())
            yield pd.Series([x.view(np.int64) if set_key(x) == key else None for x, key in zip(sets, keys.tolist(), strict=True)])
        give_back()

    texts = screened(work, docs.select("doc_id", "text"), F.col("doc_id"), nodes.select(F.col("node").alias("key")))
    texts = texts.join(nodes, F.col("doc_id") == F.col("node"))
    # Both sides go into the function, so it runs on joined rows only.
    sets = texts.select("node", "set_key", found("text", "set_key").alias("shingles")).filter("shingles IS NOT NULL")
    return sets.groupBy("node", "set_key").agg(F.first("shingles").alias("shingles")).select("node", "shingles")


def comparable(n: str, m: str, percent: int) -> str:
    return f"100 * least({n}, {m}) >= {percent} * greatest({n}, {m})"


def links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, compared in full."""
    one = sets.select(F.col("node").alias("a_node"), F.col("shingles").alias("a_set"))
    two = sets.select(F.col("node").alias("b_node"), F.col("shingles").alias("b_set"))
    both = pairs.select("a", "b").join(one, F.col("a") == F.col("a_node")).join(two, F.col("b") == F.col("b_node"))
    both = both.withColumn("common", F.size(F.array_intersect("a_set", "b_set")))
    return both.filter(f"100 * common >= {percent} * (size(a_set) + size(b_set) - common)").select("a", "b")


def block_links(group: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """Links between rows of the first and the second block that join different labels, as few as connect them."""
    one, two = (group[group["side"].isin((k, 2))] for k in (0, 1))
    value, column = np.unique(np.concatenate(group["shingles"].to_list()), return_inverse=True)
    ends = np.cumsum(group["shingles"].map(len).to_numpy())
    column = {row: np.sort(part) for row, part in zip(group.index, np.split(column, ends[:-1]), strict=True)}
    common = np.zeros((len(one), len(two)), np.float32)
    for start in range(0, len(value), COLUMNS):
        sides = []
        for side in (one, two):
            table = np.zeros((len(side), COLUMNS), np.float32)
            for i, row in enumerate(side.index):
                own = column[row]
                table[i, own[np.searchsorted(own, start) : np.searchsorted(own, start + COLUMNS)] - start] = 1
            sides.append(table)
        common += sides[0] @ sides[1].T
    total = one["n"].to_numpy()[:, None] + two["n"].to_numpy()[None, :]
    apart = one["label"].to_numpy()[:, None] != two["label"].to_numpy()[None, :]
    found = np.argwhere(apart & (100 * common.astype(np.int64) >= percent * (total - common.astype(np.int64))))
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    label_one, label_two = one["label"].tolist(), two["label"].tolist()
    node_one, node_two = one["node"].tolist(), two["node"].tolist()
    for i, j in found.tolist():
        x, y = root(label_one[i]), root(label_two[j])
        if x != y:
            parent[x] = y
            out.append((node_one[i], node_two[j]))
    return out


def rest_links(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links across the labels of each bucket of ``rest`` (bucket, node, n, label).

    A bucket is cut into blocks of about ``BLOCK`` rows and ``BLOCK_SHINGLES`` shingles, and every pair of blocks is a
    group of its own, so a task holds two blocks however large the bucket is.
    """
    size = rest.groupBy("bucket").agg(F.count(F.lit(1)).alias("held"), F.sum("n").alias("words"))
    blocks = F.greatest(F.ceil(F.col("held") / BLOCK), F.ceil(F.col("words") / BLOCK_SHINGLES)).cast("int")
    rows = rest.join(size.select("bucket", blocks.alias("blocks")), "bucket")
    rows = rows.withColumn("own", F.pmod(F.hash("node"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "bucket",
        "node",
        "n",
        "label",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
    ).join(sets, "node")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        found = block_links(group.reset_index(drop=True), percent)
        give_back()
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return rows.groupBy("bucket", "i", "j").applyInPandas(compare, "a long, b long")


def near_links(work: Work, docs: DataFrame, nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """Links among ``nodes`` (node, set_key, n, bands) that connect what belongs together."""
    rows = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    full = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    members = work.land(rows.join(full, "bucket"), "members")
    weight = members.groupBy("node").agg(F.sum("held").alias("weight")).withColumnRenamed("node", "of")
    ranked = members.join(weight, F.col("node") == F.col("of"))
    leader = ranked.groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("node")).alias("less"), F.col("n").alias("lead_n"))).alias("l"))
    leader = leader.select(F.col("bucket").alias("led"), (-F.col("l.less")).alias("leader"), F.col("l.lead_n").alias("lead_n"))
    stars = members.join(leader, F.col("bucket") == F.col("led")).filter("node != leader AND " + comparable("n", "lead_n", percent))
    stars = work.land(stars.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct(), "stars")

    used = work.land(members.select("node").distinct().join(nodes.select("node", "set_key"), "node"), "used")
    sets = work.land(shingles_of(work, docs, used, words), "sets")
    first = work.land(links(stars, sets, percent), "star-links")
    linked = components(work, first)

    label = linked.select(F.col("node").alias("of"), "label")
    labelled = members.filter("held > 2").join(label, F.col("node") == F.col("of"), "left")
    labelled = labelled.select("bucket", "node", "n", F.coalesce("label", "node").alias("label"))
    mixed = labelled.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low != high")
    rest = work.land(labelled.join(mixed.select("bucket"), "bucket"), "rest")
    second = work.land(rest_links(rest, sets, percent), "rest-links")
    return first.union(second)


def near_duplicates(work: Work, docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the least doc_id reachable over links), kept.

    ``docs`` has doc_id (long) and text. Null texts and texts without words have no shingles and no links. Rows with a
    null doc_id take no part: their component is null and they are kept. Rows that repeat a doc_id are one document,
    linked to all that any of its texts is linked to. An empty table gives an empty one.
    """
    docs = docs.select("doc_id", "text")
    rows = work.land(signatures(docs, words), "signatures")
    known = rows.filter("doc_id IS NOT NULL AND set_key IS NOT NULL")
    folded = known.groupBy("set_key").agg(F.min(F.struct("doc_id", "n", "bands")).alias("first"))
    nodes = work.land(folded.select("set_key", F.col("first.doc_id").alias("node"), "first.n", "first.bands"), "nodes")
    found = near_links(work, docs, nodes, words, percent)
    # Copies with equal sets hang on their node; a repeated doc_id ties its texts together.
    copies = known.select("set_key", "doc_id").join(nodes.select(F.col("set_key").alias("of"), "node"), F.col("set_key") == F.col("of"))
    repeated = copies.filter("doc_id != node").select("doc_id", "node").join(
        copies.select("doc_id", "node").distinct().groupBy("doc_id").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1"), "doc_id"
    )
    found = found.union(repeated.select(F.col("node").alias("a"), F.col("doc_id").alias("b")))
    label = work.land(components(work, found), "components").withColumnRenamed("node", "linked")
    own = nodes.select(F.col("set_key").alias("of"), "node").join(label, F.col("node") == F.col("linked"), "left")
    own = own.select("of", F.coalesce("label", "node").alias("component"))
    out = rows.join(own, F.col("set_key") == F.col("of"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def without_near_duplicates(work: Work, docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose document is the least of its component, with their columns."""
    (gone_id,) = fresh(docs, "gone_id")
    gone = near_duplicates(work, docs, words, percent).filter("NOT kept").select(F.col("doc_id").alias(gone_id)).distinct()
    gone = work.land(gone, "gone")
    # Any id will do for rows without one: at worst they take part in the join, which they don't match.
    return without(work, docs, F.coalesce("doc_id", F.lit(-1)), gone, F.col(gone_id), F.col("doc_id") == F.col(gone_id))

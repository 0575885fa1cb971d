"""Best-fit packing of documents into sequences, partition by partition and then up a tree.

Texts become token ids with a closing id. Documents longer than a sequence are cut into pieces of its length, the first
piece taking the remainder. Every task packs the pieces it reads by best fit, longest first, so nothing is shuffled.
After that any two bins of a task hold more than one sequence together, so at most one is half empty or less. The tree
then merges bins as items: groups of ``FAN`` blocks are packed again, round after round. A block hands on its
``FAN + 1`` emptiest bins and emits the rest as they are. No merge is lost by that: a merge needs a bin that is at most
half full, a group has at most one of those per block, and whatever it fits into is no better than one of the emptiest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilegate.llm.encoding import Encoder, Vocabulary, default_vocabulary
from profilegate.llm.tables import Work, give_back, rows_of

LENGTH = 2048
CLOSING_ID = 0
FAN = 16
BLOCK = 1 << 16
PIECES = "array<struct<piece: int, start: long, length: long, ids: binary>>"
_LEAVES = "leaf long, root long, shift long, fill long, block long"


def cut(ids: bytes, length: int) -> list[dict]:
    """Pieces of at most ``length`` ids, only the first of them shorter."""
    total = len(ids) // 4
    ends = list(range(total % length or length, total + 1, length))
    return [
        {"piece": k, "start": start, "length": end - start, "ids": ids[4 * start : 4 * end]}
        for k, (start, end) in enumerate(zip([0, *ends], ends, strict=False))
    ]


def pieces(text: Column, vocabulary: Vocabulary | None = None, length: int = LENGTH, closing_id: int = CLOSING_ID) -> Column:
    """The pieces of a text with their ids, little-endian unsigned 32-bit; null and empty texts are the closing id alone."""
    files = vocabulary or default_vocabulary()
    end = np.array([closing_id], "<u4").tobytes()

    @F.pandas_udf(PIECES)
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(files)
        for batch in batches:
            yield pd.Series([cut(encoder.encode(x or "") + end, length) for x in batch.tolist()])
        del encoder
        give_back()

    return encoded(text)


def best_fit(lengths: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and offset of each item, and how full each bin is; longest items first, each into the fullest bin it fits."""
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    left: list[int] = []
    open_bins: list[list[int]] = [[] for _ in range(length + 1)]
    rooms = 0  # bit r is set if some bin has room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            where = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, where = length, len(left)
            left.append(length)
        bins[i], offsets[i] = where, length - room
        left[where] = room - size
        if left[where]:
            open_bins[left[where]].append(where)
            rooms |= 1 << left[where]
    return bins, offsets, [length - x for x in left]


def _emptiest(fill: np.ndarray, length: int) -> np.ndarray:
    """Which bins a block hands on."""
    order = np.argsort(fill, kind="stable")[: FAN + 1]
    on = np.zeros(len(fill), bool)
    on[order] = True
    return on & (fill < length)


def _local(items: DataFrame, length: int, block: int) -> DataFrame:
    """Rows of ``items`` with block, bin, place in it, how full it is, and whether the bin is handed on."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 20

        def packed(held: list[pd.DataFrame]) -> pd.DataFrame:
            rows = pd.concat(held, ignore_index=True)
            bins, offsets, fill = best_fit(rows["length"].to_numpy(), length)
            fill = np.array(fill, np.int64)
            on = _emptiest(fill, length)
            return rows.assign(block=number, bin=(number << 20) + bins, at=offsets, fill=fill[bins], on=on[bins])

        held, n = [], 0
        for batch in batches:
            while len(batch):
                held.append(batch[: block - n])
                n += len(held[-1])
                batch = batch[len(held[-1]) :]
                if n == block:
                    yield packed(held)
                    held, n, number = [], 0, number + 1
        if n:
            yield packed(held)

    return items.mapInPandas(pack, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in items.schema)}, block long, bin long, at long, fill long, on boolean")


def _merge(work: Work, leaves: DataFrame, blocks: int, length: int) -> DataFrame:
    """Root bin of each bin handed on, and how far its content moves."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        roots = group.groupby("root", sort=True)["fill"].first()
        bins, offsets, fill = best_fit(roots.to_numpy(), length)
        fill = np.array(fill, np.int64)
        # The first root put into a bin, which lies at 0, gives it its name.
        name = np.empty(len(fill), np.int64)
        name[bins[offsets == 0]] = roots.index.to_numpy()[offsets == 0]
        place = pd.Series(np.arange(len(roots)), roots.index)[group["root"]].to_numpy()
        return group.assign(
            root=name[bins[place]], shift=group["shift"].to_numpy() + offsets[place], fill=fill[bins[place]], on=_emptiest(fill, length)[bins[place]]
        )[["leaf", "root", "shift", "fill", "block", "on"]]

    done = None
    while blocks > 1:
        blocks = -(-blocks // FAN)
        grouped = leaves.withColumn("block", F.pmod(F.xxhash64("block"), F.lit(blocks)))
        merged = work.land(grouped.groupBy("block").applyInPandas(pack, _LEAVES + ", on boolean"), "merged")
        emitted = merged.filter("NOT on").drop("on")
        done = emitted if done is None else done.union(emitted)
        leaves = merged.filter("on").drop("on")
    return leaves if done is None else done.union(leaves)


def pack(work: Work, items: DataFrame, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to the rows of ``items``, which have ``length`` from 1 to ``length``.

    ``items`` should be narrow: a task holds up to ``block`` rows at once. Sequences are filled from 0 without gaps;
    equal rows are items like any other; an empty table gives an empty one. Columns called block, bin, at, fill, on,
    sequence_id or offset are replaced.
    """
    plain = items.drop("block", "bin", "at", "fill", "on", "sequence_id", "offset")
    local = work.land(_local(plain, length, block), "packed")
    bins = local.filter("on").select(
        F.col("bin").alias("leaf"), F.col("bin").alias("root"), F.lit(0).cast("long").alias("shift"), "fill", "block"
    ).distinct()
    bins = work.land(bins, "bins")
    moved = _merge(work, bins, rows_of(bins.select("block").distinct()), length)
    moved = work.land(moved.filter("leaf != root OR shift != 0").select("leaf", "root", "shift"), "moved")
    out = local.join(moved, F.col("bin") == F.col("leaf"), "left")
    return out.select(
        *plain.columns,
        F.coalesce("root", "bin").alias("sequence_id"),
        (F.col("at") + F.coalesce("shift", F.lit(0))).alias("offset"),
    )


def pack_documents(work: Work, docs: DataFrame, vocabulary: Vocabulary | None = None, length: int = LENGTH) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset; ``docs`` has doc_id and text."""
    cuts = docs.select("doc_id", F.explode(pieces(F.col("text"), vocabulary, length)).alias("p"))
    cuts = cuts.select("doc_id", "p.piece", "p.start", "p.length", F.crc32("p.ids").alias("ids_crc32"))
    return pack(work, work.land(cuts, "pieces"), length)


def sequences(docs: DataFrame, packed: DataFrame, vocabulary: Vocabulary | None = None, length: int = LENGTH) -> DataFrame:
    """The token ids of every sequence, as array<int>; at most ``length`` ids meet in a group.

    ``packed`` comes from ``pack_documents`` over the same ``docs``, whose doc_ids differ.
    """
    cuts = docs.select("doc_id", F.explode(pieces(F.col("text"), vocabulary, length)).alias("p"))
    parts = cuts.select("doc_id", "p.piece", "p.ids").join(packed.select("doc_id", "piece", "sequence_id", "offset"), ["doc_id", "piece"])
    whole = parts.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))

    @F.pandas_udf("array<int>")
    def ids(parts: pd.Series) -> pd.Series:
        return parts.map(lambda row: np.concatenate([np.frombuffer(x["ids"], "<u4") for x in row]).astype(np.int32))

    return whole.select("sequence_id", ids("parts").alias("ids"))

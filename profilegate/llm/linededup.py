"""Removal of line chunks that repeat anywhere in the corpus.

Lines are hashed, and a rolling hash over the hashes of two lines decides where a chunk ends, so boundaries move with
the lines and not with their numbers. A line of ``LONG_LINE`` words or more is a chunk by itself, whatever surrounds it.
Chunks of several lines, and these long lines, are compared over all documents by digest; of each chunk that occurs more
than once, the first occurrence (least doc_id, then position) stays and the others are removed. Before that, the bytes
behind each repeated digest are compared: every task keeps the least and the greatest chunk it sees of it, and a digest
whose ends differ is left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilegate.llm import fuse
from profilegate.llm.tables import Work, fresh, rows_of

MODULUS = 3
FACTOR = 31
LONG_LINE = 50
KEYS_PER_FILTER = 20_000
LEAST_FILTERS = 64
MOST_FILTER_BYTES = 32 << 20
CHUNKS = "array<struct<pos: int, lines: int, digest: string>>"
FOUND = "array<struct<pos: int, digest: string>>"


def line_hash(line: bytes) -> int:
    return int.from_bytes(hashlib.md5(line, usedforsecurity=False).digest()[:4])


def chunks(text: str) -> list[tuple[int, int, bool, bytes]]:
    """(number of the chunk, lines, whether it is compared, bytes) of all chunks of a text, in order."""
    out: list[tuple[int, int, bool, bytes]] = []
    held: list[bytes] = []
    before = None

    def close() -> None:
        if held:
            whole = b"\n".join(held)
            compared = len(held) > 1 or len(whole.split()) >= LONG_LINE
            out.append((len(out), len(held), compared and bool(whole.strip()), whole))
            held.clear()

    for line in text.encode("utf-8", "surrogatepass").split(b"\n"):
        own = line_hash(line)
        long_line = len(line.split()) >= LONG_LINE
        if long_line:
            close()
        held.append(line)
        if long_line or (before is not None and (before * FACTOR + own) % MODULUS == 0):
            close()
        before = own
    close()
    return out


def _digest(chunk: bytes) -> str:
    return hashlib.blake2b(chunk, digest_size=16).hexdigest()


def _short(digest: str) -> int:
    return int(digest[:15], 16)


def chunk_digests(text: Column) -> Column:
    @F.pandas_udf(CHUNKS)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda x: [{"pos": p, "lines": n, "digest": _digest(c)} for p, n, on, c in chunks(x) if on] if x is not None else [])

    return found(text)


def _filters(repeated: DataFrame, buckets: int) -> DataFrame:
    def one(group: pd.DataFrame) -> pd.DataFrame:
        keys = np.array([_short(x) for x in group["digest"]], np.int64)
        return pd.DataFrame({"bucket": group["bucket"][:1], "filter": [fuse.build(keys)]})

    short = F.conv(F.substring("digest", 1, 15), 16, 10).cast("long")
    keyed = repeated.select("digest", F.pmod(short, F.lit(buckets)).cast("int").alias("bucket"))
    return keyed.groupBy("bucket").applyInPandas(one, "bucket int, filter binary")


def clashing(work: Work, docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """Digests behind which there are different bytes."""
    buckets = max(LEAST_FILTERS, -(-rows_of(repeated) // KEYS_PER_FILTER))
    built = work.land(_filters(repeated, buckets), "filters")
    table = None
    if (built.agg(F.sum(F.length("filter"))).first()[0] or 0) <= MOST_FILTER_BYTES:
        table = work.spark.sparkContext.broadcast({r["bucket"]: bytes(r["filter"]) for r in built.collect()})

    @F.pandas_udf("array<struct<digest: string, chunk: binary>>")
    def repeats(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def maybe(text: str) -> list[dict]:
            parts = [(_digest(c), c) for _, _, on, c in chunks(text) if on]
            if table is not None and parts:
                short = np.array([_short(d) for d, _ in parts], np.int64)
                bucket = short % buckets
                hit = np.zeros(len(parts), bool)
                for b in np.unique(bucket).tolist():
                    if b in table.value:
                        where = bucket == b
                        hit[where] = fuse.probe(table.value[b], short[where])
                parts = [p for p, h in zip(parts, hit, strict=True) if h]
            return [{"digest": d, "chunk": c} for d, c in parts]

        for batch in batches:
            yield batch.map(lambda x: maybe(x) if x is not None else [])

    rows = docs.select(F.explode(repeats("text")).alias("c")).select("c.digest", "c.chunk")
    ends = rows.groupBy("digest").agg(F.min("chunk").alias("least"), F.max("chunk").alias("greatest"))
    return ends.filter("least != greatest").select("digest")


def removals(work: Work, docs: DataFrame) -> DataFrame:
    """The row and the chunks to remove from it, an array of pos and digest; ``docs`` has row (unique), doc_id and text."""
    # Under one id the hash of the text comes first, so what is left of the texts doesn't hang on how rows are numbered.
    rows = docs.select("row", "doc_id", F.xxhash64("text").alias("tie"), F.explode(chunk_digests(F.col("text"))).alias("c"))
    rows = work.land(rows.select("row", "doc_id", "tie", "c.pos", "c.digest"), "chunks")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie", "row", "pos")
    repeated = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("times"), F.min(place).alias("first")).filter("times > 1")
    repeated = work.land(repeated.select("digest", F.col("first.row").alias("first_row"), F.col("first.pos").alias("first_pos")), "repeated")
    repeated = repeated.join(work.land(clashing(work, docs, repeated), "clashes"), "digest", "left_anti")
    later = rows.select("row", "pos", "digest").join(repeated, "digest").filter("NOT (row = first_row AND pos = first_pos)")
    return later.groupBy("row").agg(F.collect_set(F.struct("pos", "digest")).alias("gone"))


def without_repeated_lines(work: Work, docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated chunks cut out of text, and the number of ``removed_lines``.

    ``docs`` has doc_id and text; other columns stay, but for one called removed_lines. Null texts stay null and empty ones empty, with nothing removed;
    a text whose chunks all repeat earlier ones becomes empty. Chunks of white space alone are left. A null doc_id comes
    last in order. Every row is a document of its own, also under a null or repeated doc_id; of rows that share one, the
    text with the least xxhash64 comes first.
    """
    plain = docs.drop("removed_lines")
    row, gone_row, gone, result = fresh(plain, "row", "gone_row", "gone", "cut")
    kept = work.land(plain.withColumn(row, F.monotonically_increasing_id()), "documents")
    marked = work.land(removals(work, kept.select(F.col(row).alias("row"), "doc_id", "text")), "removals")
    marked = marked.select(F.col("row").alias(gone_row), F.col("gone").alias(gone))

    @F.pandas_udf("text string, removed_lines long")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        def one(text: str | None, marked) -> tuple[str | None, int]:
            if text is None or marked is None:
                return text, 0
            out = {(x["pos"], x["digest"]) for x in marked}
            kept, lines = [], 0
            for pos, n, compared, chunk in chunks(text):
                if compared and (pos, _digest(chunk)) in out:
                    lines += n
                else:
                    kept.append(chunk)
            return b"\n".join(kept).decode("utf-8", "surrogatepass"), lines

        for texts, marks in batches:
            yield pd.DataFrame([one(t, m) for t, m in zip(texts.tolist(), marks.tolist(), strict=True)], columns=["text", "removed_lines"])

    out = kept.join(marked, F.col(row) == F.col(gone_row), "left").withColumn(result, cut(F.col("text"), F.col(gone)))
    columns = [F.col(result)["text"].alias(c) if c == "text" else F.col(f"`{c}`") for c in plain.columns]
    return out.select(*columns, F.col(result)["removed_lines"].alias("removed_lines"))


ORACLE_SQL = """
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text IS NOT NULL),
h AS (
  SELECT *, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS h,
    len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS words FROM l),
e AS (
  SELECT *, words >= 50 OR coalesce((lag(h) OVER w * 31 + h) % 3 = 0, false) OR coalesce(lead(words) OVER w >= 50, false) AS ends
  FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
n AS (
  SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM e),
c AS (
  SELECT doc_id, pos, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) AS lines, sum(words) AS words FROM n GROUP BY ALL),
r AS (
  SELECT *, (lines > 1 OR words >= 50) AND words > 0
    AND row_number() OVER (PARTITION BY chunk ORDER BY doc_id, pos) > 1 AS gone FROM c),
d AS (
  SELECT doc_id, coalesce(string_agg(chunk, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text,
    CAST(coalesce(sum(lines) FILTER (gone), 0) AS BIGINT) AS removed_lines FROM r GROUP BY doc_id)
SELECT o.doc_id, coalesce(d.removed_lines, 0) AS removed_lines, CASE WHEN o.text IS NOT NULL THEN d.text END AS text
FROM documents o LEFT JOIN d ON o.doc_id = d.doc_id
"""

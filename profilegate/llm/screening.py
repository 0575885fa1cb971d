"""Leaving out rows that can't match a set of keys, before they are shuffled."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilegate.llm import fuse
from profilegate.llm.tables import Work, give_back, rows_of

KEYS_PER_FILTER = 20_000
LEAST_FILTERS = 64
MOST_FILTER_BYTES = 32 << 20


def filter_table(keys: DataFrame, buckets: int) -> DataFrame:
    """A binary-fuse filter for each bucket of the keys (one column ``key``, long)."""

    def one(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"bucket": group["bucket"][:1], "filter": [fuse.build(group["key"].to_numpy())]})

    return keys.select(F.pmod(F.hash("key"), F.lit(buckets)).alias("bucket"), "key").groupBy("bucket").applyInPandas(one, "bucket int, filter binary")


def bucket_count(keys: DataFrame) -> int:
    return max(LEAST_FILTERS, -(-rows_of(keys) // KEYS_PER_FILTER))


def screen(work: Work, key: Column, keys: DataFrame) -> Column | None:
    """Whether ``key`` (long) may be among ``keys``: true for all that are, and for a few others; false for null.

    The filters are sent to all tasks, so there are none (None) if they would take more than ``MOST_FILTER_BYTES``.
    Results may not depend on rows being left out.
    """
    buckets = bucket_count(keys)
    built = work.land(filter_table(keys, buckets), "screen")
    if (built.agg(F.sum(F.length("filter"))).first()[0] or 0) > MOST_FILTER_BYTES:
        return None
    table = work.spark.sparkContext.broadcast({r["bucket"]: bytes(r["filter"]) for r in built.collect()})

    @F.pandas_udf("boolean")
    def maybe(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for bucket, value in batches:
            hit = np.zeros(len(value), bool)
            known = value.notna().to_numpy()
            own = value.fillna(0).to_numpy(np.int64)
            for b, where in bucket.groupby(bucket).indices.items():
                if b in table.value:
                    hit[where] = fuse.probe(table.value[b], own[where])
            yield pd.Series(hit & known)
        give_back()

    return maybe(F.pmod(F.hash(key), F.lit(buckets)), key)


def screened(work: Work, rows: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """The rows whose ``key`` (long) is among ``keys``, and a few others; all rows if the filters are too large."""
    maybe = screen(work, key, keys)
    return rows if maybe is None else rows.filter(maybe)


def without(work: Work, rows: DataFrame, key: Column, gone: DataFrame, gone_key: Column, match: Column) -> DataFrame:
    """The rows that match none of ``gone``; equal ``key`` and ``gone_key`` (long) must follow from ``match``.

    Rows the filters clear of being among ``gone`` stay where they are, and only the others are shuffled for the join.
    """
    maybe = screen(work, key, gone.select(gone_key.alias("key")))
    if maybe is None:
        return rows.join(gone, match, "left_anti")
    return rows.filter(~maybe).unionByName(rows.filter(maybe).join(gone, match, "left_anti"))

"""Counts of hashed features by class, summed over tasks in slices, so that no task gathers a whole class."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from profilegate.llm.tables import give_back

SLICE = 1024
_PARTIAL = "class string, slice int, counts binary"


def count_features(df: DataFrame, features: Callable[[list], Iterator[np.ndarray]], buckets: int, most_classes: int = 4096) -> dict[str, np.ndarray]:
    """Total counts per value of ``class``; ``df`` has class and text.

    ``features`` turns texts into arrays of bucket numbers. What reaches the driver is one array of ``buckets``
    counts per class; more than ``most_classes`` classes are an error.
    """

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, part in batch.groupby("class", sort=True):
                into = sums.setdefault(name, np.zeros(buckets, np.int64))
                for found in features(part["text"].tolist()):
                    into += np.bincount(found, minlength=buckets)
        rows = [
            (name, k, part.tobytes())
            for name, total in sums.items()
            for k, part in enumerate(total.reshape(-1, SLICE))
            if part.any()
        ]
        yield pd.DataFrame(rows, columns=["class", "slice", "counts"])
        give_back()

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(x, np.int64) for x in group["counts"]], axis=0)
        return pd.DataFrame({"class": group["class"][:1], "slice": group["slice"][:1], "counts": [total.tobytes()]})

    summed = df.select("class", "text").mapInPandas(partial, _PARTIAL).groupBy("class", "slice").applyInPandas(add, _PARTIAL)
    out: dict[str, np.ndarray] = {}
    for row in summed.toLocalIterator():
        if row["class"] not in out:
            if len(out) == most_classes:
                raise ValueError(f"more than {most_classes} classes")
            out[row["class"]] = np.zeros(buckets, np.int64)
        at = row["slice"] * SLICE
        out[row["class"]][at : at + SLICE] = np.frombuffer(row["counts"], np.int64)
    return dict(sorted(out.items()))

"""Keeps computed columns computed once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settle(df: DataFrame, columns: Mapping[str, Column], observe_as: str | None = None, **metrics: Column) -> DataFrame:
    """Adds computed columns that Catalyst evaluates once, whatever is filtered or selected above.

    A filter on a computed column is usually pushed beneath the projection that computes it, by pasting
    the whole expression into the filter; for a column built from dozens of rules that doubles the work
    and can blow the plan up. Here the columns come out of a generator with one row for each row. Filters
    on them stay above it, while filters on the columns that pass through, and column pruning, go down
    to the scan. With ``observe_as``, which is for jobs that report their counts, the metrics are
    observed under that name; filters do not pass an observation.
    """
    kept = [c for c in df.columns if c not in columns]
    # A projection computes them, in generated code; the generator only wraps and unwraps what is there, since Spark
    # interprets generators in stages whose code it does not fuse.
    df = df.select(*kept, *[column.alias(name) for name, column in columns.items()])
    row = F.struct(*columns)
    out = df.select(*kept, F.explode(F.array(row)).alias("_settled"))
    out = out.select(*kept, *[F.col("_settled")[name].alias(name) for name in columns])
    if observe_as is None:
        return out
    return out.observe(observe_as, *[column.alias(key) for key, column in metrics.items()])

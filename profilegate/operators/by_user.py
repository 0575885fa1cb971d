"""Rows dealt out by user, for work that needs a user's rows together.

A user with more rows than a task should have is dealt over several tasks by a salt. What is worked out for each slice of
such a user is then put together in a second, small step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilegate.operators.views import USER_KEY, latest_per_key

SLICE = "_slice"


def hot_users(df: DataFrame, tasks: int, keys: Sequence[str] = USER_KEY, share: float = 0.5) -> DataFrame:
    """keys and ``slices`` of users that own more than ``share`` of a task's even part of all rows.

    There can be at most ``tasks / share`` of them, however many rows or users there are. Counts fold in the map tasks.
    """
    if tasks < 1 or not 0 < share <= 1:
        raise ValueError("tasks must be at least 1 and share within (0, 1]")
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    most = max(1.0, share * total / tasks)
    slices = F.least(F.ceil(F.col("_n") / most), F.lit(tasks)).cast("int")
    return counts.filter(F.col("_n") > most).select(*keys, slices.alias("slices"))


def by_user(df: DataFrame, tasks: int, keys: Sequence[str] = USER_KEY, share: float = 0.5) -> DataFrame:
    """All rows of a user in one of ``tasks`` tasks, and those of a hot user in as many as they fill; adds ``_slice``.

    The one shuffle is by key and slice, so grouping or sorting by these needs no other. Null keys are keys like any
    other. ``df`` is read twice, once for its keys alone: hand over a table or something that is kept.
    """
    hot = F.broadcast(hot_users(df, tasks, keys, share).select(*[F.col(k).alias(f"_hot_{k}") for k in keys], "slices"))
    same = [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys]
    # Rows are counted off, as a hot user's may all be alike; a table is read in the same order by a task that runs again.
    salt = F.pmod(F.monotonically_increasing_id(), F.col("slices"))
    marked = df.join(hot, same, "left").withColumn(SLICE, F.coalesce(salt, F.lit(0)).cast("int"))
    return marked.select(*df.columns, SLICE).repartition(tasks, *keys, SLICE)


def newest_by_user(
    df: DataFrame, order: Sequence[str], tasks: int, keys: Sequence[str] = USER_KEY, within: Sequence[str] = (), share: float = 0.5
) -> DataFrame:
    """The newest row of each user (and of each value of ``within``) by ``order``: of every slice first, then of these."""
    group = [*keys, *within]
    return latest_per_key(latest_per_key(by_user(df, tasks, keys, share), [*group, SLICE], order).drop(SLICE), group, order)

"""Queryable views over checked profiles and invalid events, laid out by how they are asked for."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from profilegate.operators import metrics, rejects
from profilegate.operators import rules as R
from profilegate.operators.committed import OWNER, PART, Dates, State, Table, schema_of, value_of

LOAD = OWNER
WHOLE = "whole"
USER_KEY = ("source", "source_user_id")


def latest_valid(checked: DataFrame, n: int, ts: str = "ingested_at", tie: Sequence[str] = ("source_user_id",)) -> DataFrame:
    """The n most recent valid rows; each task keeps its own n before they meet."""
    return checked.filter(R.is_valid()).orderBy(F.col(ts).desc(), *tie).limit(n)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key by ``order``, the last of it breaking ties.

    An aggregation instead of a window: every task keeps one row per key before the shuffle, so a
    key that owns a third of the table sends no more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def profiles_by_country(checked: DataFrame) -> DataFrame:
    return checked.filter(R.is_valid()).groupBy("country").agg(F.count("*").alias("profiles"))


def invalid_by_reason(invalid: DataFrame, ts: str = "processed_at", *carry: str) -> DataFrame:
    """One row per rejection reason of each invalid event."""
    return invalid.select(F.explode(R.REASONS).alias("reason"), F.col(ts), *carry)


def latest_invalid_by_reason(by_reason: DataFrame, k: int, ts: str = "processed_at", tie: Sequence[str] = ("source_user_id",)) -> DataFrame:
    """The k newest rejects of each reason.

    Up to ``spark.sql.optimizer.windowGroupLimitThreshold`` Spark limits each map task to k rows of a reason
    before the shuffle; a larger k gives the same rows with more of them shuffled.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    w = W.partitionBy("reason").orderBy(F.col(ts).desc(), *tie)
    return by_reason.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def write_view(
    df: DataFrame, path: str, partition_by: Sequence[str], mode: str = "errorifexists", load: str | None = None, dates: Dates | None = None
) -> None:
    """Partitioned Parquet, with files of even size, that readers see once it is whole (``read_view``).

    A view that is there already is left alone, or replaced with ``mode`` overwrite. To add to it, name the ``load``:
    writing the same load again replaces all its rows, also those of partitions the new rows have none of, and touches
    no other load. A job that dies on the way leaves the view as it was. ``dates`` tells expiry how the view is laid
    out by date.
    """
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError(f"mode must be errorifexists or overwrite, not {mode!r}")
    table = Table(df.sparkSession, path)
    if load is None and mode == "errorifexists" and table.exists():
        raise FileExistsError(f"[PATH_ALREADY_EXISTS] {path}")
    if OWNER in df.columns or PART in df.columns:
        raise ValueError(f"the columns {OWNER} and {PART} are the view's own")
    owner = WHOLE if load is None else load
    dirs = table.put(df, partition_by, owner)
    fresh = State(schema_of(df), tuple(partition_by), dates, tuple(dirs))

    def change(state: State | None) -> State:
        if state is None or load is None:
            if state is not None and mode == "errorifexists":
                raise FileExistsError(f"[PATH_ALREADY_EXISTS] {path}")
            return fresh
        if (state.partition_by, state.dates) != (fresh.partition_by, fresh.dates) or {*state.fields.names} != {*df.columns}:
            raise ValueError(f"a load must have the columns and the layout of the view at {path}")
        return state.swap(state.of(owner), dirs)

    table.commit(change)


def replace_loads(df: DataFrame, path: str, partition_by: Sequence[str], load: str, loads: Sequence[str], dates: Dates | None = None) -> None:
    """Replace the rows of all ``loads`` by ``df``, whose column ``load`` says which of them a row belongs to, in one commit.

    Loads that get no rows are emptied. A row of a load that isn't named stays out, as that load's other rows would double it.
    """
    table = Table(df.sparkSession, path)
    rows = df.filter(F.col(load).isin(list(loads))).withColumnRenamed(load, OWNER)
    dirs = table.put(rows, partition_by)
    known = set(loads)

    def change(state: State | None) -> State:
        state = state or State(schema_of(rows.drop(OWNER)), tuple(partition_by), dates)
        return state.swap({d for d in state.dirs if value_of(d, OWNER) in known}, dirs)

    table.commit(change)


def read_view(spark: SparkSession, path: str, loads: bool = False) -> DataFrame:
    """The rows of the last committed state; with ``loads``, the load each comes from. Filters prune directories."""
    return Table(spark, path).read(owner=loads)


def drop_load(spark: SparkSession, path: str, load: str) -> None:
    """Take a load out of a view."""
    Table(spark, path).commit(lambda state: state and state.swap(state.of(load), []))


def dated(df: DataFrame, ts: str, unit: str = "day", date_column: str = "event_date") -> DataFrame:
    """Adds the date a view is laid out by: the day of ``ts``, or the first of its week or month."""
    return df.withColumn(date_column, F.trunc(ts, unit) if unit != "day" else F.to_date(ts))


def write_latest_valid(checked: DataFrame, path: str, ts: str, *carry: str, unit: str = "day", load: str | None = None) -> None:
    """Valid events by date of ingestion, so the latest ones are found in the last directories."""
    rows = dated(rejects.valid_events(checked, ts, *carry), ts, unit)
    write_view(rows, path, ["event_date"], load=load, dates=Dates(unit=unit, ts=ts))


def write_invalid_by_reason(invalid: DataFrame, path: str, ts: str, *carry: str, unit: str = "day", load: str | None = None) -> None:
    """Rejects by reason and date of processing, one row for each reason."""
    rows = dated(invalid_by_reason(invalid, ts, *carry), ts, unit)
    write_view(rows, path, ["reason", "event_date"], load=load, dates=Dates(unit=unit, ts=ts))


def write_counters(checked: DataFrame, path: str, ts: str, unit: str = "day", load: str | None = None) -> None:
    """Rows per date, status and source."""
    rows = dated(checked.select(ts, "source", metrics.status().alias("validation_status")), ts, unit)
    counts = rows.groupBy("event_date", "validation_status", "source").agg(F.count("*").alias("profiles"))
    write_view(counts, path, ["event_date"], load=load, dates=Dates(unit=unit))


def first_kept(today: dt.date, keep_days: int) -> dt.date:
    """The oldest day of a retention period of so many days, today included."""
    if keep_days < 1:
        raise ValueError("keep_days must be at least 1")
    return today - dt.timedelta(days=keep_days - 1)


def next_unit(start: dt.date, unit: str) -> dt.date:
    """The first day after the day, week or month that starts on a date."""
    if unit == "month":
        return (start.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
    return start + dt.timedelta(days=7 if unit == "week" else 1)


def retained(view: DataFrame, today: dt.date, keep_days: int, dates: Dates = Dates()) -> DataFrame:  # noqa: B008
    """Rows within the retention period, by their own day where ``dates`` has a ``ts``; prunes directories by date.

    Rows without a date are kept: nothing tells that they are old.
    """
    first = first_kept(today, keep_days)
    start = F.lit(first) if dates.unit == "day" else F.trunc(F.lit(first), dates.unit)
    kept = F.col(dates.column).isNull() | (F.col(dates.column) >= start)
    if dates.ts is not None:
        kept &= F.col(dates.ts).isNull() | (F.col(dates.ts) >= F.lit(first))
    return view.filter(kept)


def expire(spark: SparkSession, path: str, today: dt.date, keep_days: int) -> list[str]:
    """Remove from a dated view, and from disk, all rows older than the retention period; returns the dates it touched.

    Directories are found by their date at whatever depth of the layout. One whose day, week or month is over is removed
    without reading it. One in which the period begins is cut by the rows' own days if the view's ``dates`` name a
    ``ts``, and otherwise stays until it is over. All other files stay as they are, and so do rows without a date.
    Readers see the view before or after the change; those that still read the removed directories fail.
    """
    first, table = first_kept(today, keep_days), Table(spark, path)
    while True:
        state = table.state()
        dates = state.dates
        if dates is None:
            raise ValueError(f"the view at {path} is not laid out by date")
        start = {d: value_of(d, dates.column) for d in state.dirs}
        start = {d: dt.date.fromisoformat(v) for d, v in start.items() if v is not None}
        over = [d for d, day in start.items() if next_unit(day, dates.unit) <= first]
        cut = [d for d, day in start.items() if day < first < next_unit(day, dates.unit)] if dates.ts else []
        if cut:  # only those that do hold older rows, which the files' statistics mostly tell
            cut = table.dirs_of(table.read(state, cut).filter(F.col(dates.ts) < F.lit(first)))
        if not over and not cut:
            return []
        into = []
        if cut:
            rows = retained(table.read(state, cut, owner=True), today, keep_days, dates)
            into = table.put(rows, state.partition_by)
        out = {*over, *cut}
        # Directories that another writer has replaced meanwhile may not come back: then all starts over.
        done = table.commit(lambda last: last.swap(out, into) if out <= {*last.dirs} else None)  # noqa: B023
        if done is not None:
            table.remove(sorted(out))
            return sorted({start[d].isoformat() for d in out})
        table.remove(into)

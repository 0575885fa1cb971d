"""Idempotent view maintenance from a stream.

Each micro-batch is dealt out by user, folded to the newest row of each user and day, and committed as directories of its
own together with its number. A batch that runs again after its commit changes nothing, one that died before it is
written anew; a query with a fresh checkpoint, or a second query on the same view, is told apart by its id. Readers fold
the batches by key. Days that many batches have written to are merged into one directory each, so reading a day and
listing the view cost the same after a thousand batches as after ten.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from profilegate.operators.by_user import newest_by_user
from profilegate.operators.committed import Dates, State, Table, schema_of, value_of
from profilegate.operators.views import latest_per_key
from profilegate.streaming.sink import query_of

MERGED = "merged"


def write_batch(
    batch: DataFrame, query_id: str, batch_id: int, path: str, keys: Sequence[str], order: Sequence[str], date_column: str, tasks: int | None = None
) -> bool:
    """Fold one micro-batch to the newest row per key and day and commit it; false if it is in already.

    ``tasks`` is the number of tasks users are dealt to, that of shuffle partitions by default.
    """
    table = Table(batch.sparkSession, path)
    if table.has_batch(query_id, batch_id):
        return False
    tasks = tasks or int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    batch = batch.persist()
    try:
        folded = newest_by_user(batch, order, tasks, keys, [date_column])
        dirs = table.put(folded, [date_column], f"{query_id}-{batch_id}")
    finally:
        batch.unpersist()
    return table.commit_batch(query_id, batch_id, dirs, State(schema_of(batch), (date_column,), Dates(date_column)))


def compact(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], most: int = 8) -> list[str]:
    """Merge every day that lies in more than ``most`` directories into one; returns these days.

    Batches may be committed meanwhile. If the merged directories are replaced meanwhile, nothing is changed.
    """
    table = Table(spark, path)
    state = table.last()[1]
    if state is None:
        return []
    (date_column,) = state.partition_by
    days: dict[str, list[str]] = {}
    for d in state.dirs:
        days.setdefault(value_of(d, date_column) or "", []).append(d)
    out = sorted(d for dirs in days.values() if len(dirs) > most for d in dirs)
    if not out:
        return []
    merged = latest_per_key(table.read(state, out), [*keys, date_column], order)
    into = table.put(merged, state.partition_by, MERGED)
    if table.commit(lambda last: last.swap(out, into) if {*out} <= {*last.dirs} else None) is None:
        table.remove(into)
        return []
    return sorted(day for day, dirs in days.items() if len(dirs) > most)


def start_upsert(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    ts: str,
    date_column: str = "event_date",
    compact_every: int = 20,
    most: int = 8,
    **trigger,
) -> StreamingQuery:
    """Keep a view of the newest row per key and day; every ``compact_every`` batches, crowded days are merged (0: never)."""
    dated = stream.withColumn(date_column, F.to_date(ts))

    def body(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        write_batch(batch, query_of(batch), batch_id, path, keys, order, date_column)
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact(spark, path, keys, order, most)

    writer = dated.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "30 seconds"})).start()


def current_rows(
    spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], *, date_column: str = "event_date", per_day: bool = True
) -> DataFrame:
    """The newest row per key (and day). Filters on the date prune directories."""
    return latest_per_key(Table(spark, path).read(), [*keys, date_column] if per_day else list(keys), order)

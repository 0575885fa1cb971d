"""A file sink for any stream whose batches come out exactly once.

A batch is written where no reader looks and becomes part of the table by one commit that also records its number. If the
job dies before that, the batch is run and written again; if it dies after it, before Spark has noted the batch as done,
the batch is run again and found to be in. Several queries may write to one table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from profilegate.operators.committed import Dates, State, Table, schema_of

Step = Callable[[str, int], None]


def query_of(batch: DataFrame) -> str:
    """The id of the streaming query a batch belongs to; it stays the same as long as the checkpoint does."""
    query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query_id:
        raise RuntimeError("the streaming query of this batch is not known")
    return query_id


def append_batch(
    batch: DataFrame, query_id: str, batch_id: int, path: str, partition_by: Sequence[str] = (), dates: Dates | None = None, on_step: Step | None = None
) -> bool:
    """Write and commit one batch; false if it is in already. ``on_step`` hears of "written" and "committed"."""
    table = Table(batch.sparkSession, path)
    if table.has_batch(query_id, batch_id):
        return False
    dirs = table.put(batch, partition_by, f"{query_id}-{batch_id}")
    if on_step is not None:
        on_step("written", batch_id)
    new = table.commit_batch(query_id, batch_id, dirs, State(schema_of(batch), tuple(partition_by), dates))
    if on_step is not None:
        on_step("committed", batch_id)
    return new


def start_table(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    *,
    partition_by: Sequence[str] = (),
    dates: Dates | None = None,
    name: str | None = None,
    on_step: Step | None = None,
    **trigger,
) -> StreamingQuery:
    """Append a stream to a committed table, each batch exactly once, whatever fails on the way."""

    def body(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, query_of(batch), batch_id, path, partition_by, dates, on_step)

    writer = stream.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    writer = writer if name is None else writer.queryName(name)
    return writer.trigger(**(trigger or {"processingTime": "30 seconds"})).start()

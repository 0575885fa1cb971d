"""Late rows beside those on time, none lost.

A stateful operator drops rows behind its watermark without a trace but a count. Here a stream is split before that, by the
same rule: a batch's watermark is the latest event time of the batches before it less the delay, and rows at or behind it
are late. Where several operators of a query may be stateful, Spark drops a row one batch later than that, so what it drops
is always among the late rows here. The latest event time is committed with each batch, so a batch that runs again is split
the same way, also after a restart.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from profilegate.operators.committed import OWNER, State, Table, schema_of
from profilegate.streaming.sink import query_of

SIDE, ON_TIME, LATE, BATCH = "side", "on_time", "late", "batch_id"


def is_late(ts: str, watermark_ms: int | None) -> Column:
    """Whether a row is behind a watermark; rows without event time are on time, and so are all while there is none."""
    if watermark_ms is None:
        return F.lit(False)
    return F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")) <= F.lit(watermark_ms * 1000), F.lit(False))


def split_batch(batch: DataFrame, query_id: str, batch_id: int, path: str, ts: str, delay: dt.timedelta) -> bool:
    """Write one batch, late rows apart from the others, and commit both with the latest event time; false if it is in."""
    table = Table(batch.sparkSession, path)
    if table.has_batch(query_id, batch_id):
        return False
    state = table.last()[1]
    mark = state.marks.get(query_id) if state is not None else None
    watermark = None if mark is None else mark - int(delay / dt.timedelta(milliseconds=1))
    rows = batch.withColumn(SIDE, F.when(is_late(ts, watermark), F.lit(LATE)).otherwise(F.lit(ON_TIME)))
    rows = rows.persist()
    try:
        latest = rows.agg(F.max(F.unix_millis(F.col(ts).cast("timestamp")))).first()[0]
        dirs = table.put(rows, [SIDE], f"{query_id}-{batch_id}")
    finally:
        rows.unpersist()
    known = [x for x in (mark, latest) if x is not None]
    return table.commit_batch(query_id, batch_id, dirs, State(schema_of(rows), (SIDE,)), max(known, default=None))


def start_split(stream: DataFrame, path: str, checkpoint: str, *, ts: str, delay: dt.timedelta, **trigger) -> StreamingQuery:
    def body(batch: DataFrame, batch_id: int) -> None:
        split_batch(batch, query_of(batch), batch_id, path, ts, delay)

    writer = stream.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "30 seconds"})).start()


def read_split(spark: SparkSession, path: str) -> DataFrame:
    """All rows with their ``side`` and ``batch_id``; a filter on the side prunes directories."""
    rows = Table(spark, path).read(owner=True)
    return rows.withColumn(BATCH, F.substring_index(OWNER, "-", -1).cast("long")).drop(OWNER)

"""Micro-batch metrics as a table: one row for every batch of every query, however long they run.

A listener writes each progress report to a file named after query and batch. A batch that is reported again, after a
restart or because it ran twice, overwrites its own file, so rows never double.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

SCHEMA = (
    "query_id string, run_id string, query_name string, batch_id long, started_at timestamp, duration_ms long, input_rows long, "
    "sink_rows long, late_rows long, state_rows long, watermark string, observed map<string, long>"
)


class ProgressLog(StreamingQueryListener):
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = path.rstrip("/")
        self._jvm = spark._jvm
        self._files = self._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._written: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        observed = {}
        for name, row in p.observedMetrics.items():
            observed |= {f"{name}.{key}": value for key, value in row.asDict().items() if isinstance(value, int)}
        report = {
            "query_id": str(p.id),
            "run_id": str(p.runId),
            "query_name": p.name,
            "batch_id": p.batchId,
            "started_at": p.timestamp,
            "duration_ms": p.batchDuration,
            "input_rows": p.numInputRows,
            "sink_rows": p.sink.numOutputRows,
            "late_rows": sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
            "state_rows": sum(s.numRowsTotal for s in p.stateOperators),
            "watermark": p.eventTime.get("watermark"),
            "observed": observed,
        }
        # Written beside and moved into place, so that readers never meet half a report.
        name = f"{self.path}/query={p.id}/{p.batchId:012d}.json"
        target = self._jvm.org.apache.hadoop.fs.Path(name)
        draft = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/query={p.id}/.{p.batchId:012d}.{p.runId}")
        stream = self._files.create(draft, True)
        stream.write(bytearray(json.dumps(report).encode()))
        stream.close()
        self._files.delete(target, False)
        self._files.rename(draft, target)
        self._written[str(p.id)] = p.batchId

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until the last batch of a query that has ended is written; reports come a little after the batch."""
        last = query.lastProgress
        until = time.monotonic() + seconds
        while last is not None and self._written.get(str(query.id), -1) < last.batchId:
            if time.monotonic() > until:
                raise TimeoutError(f"no report of batch {last.batchId} of query {query.id}")
            time.sleep(0.05)


def log_progress(spark: SparkSession, path: str) -> ProgressLog:
    """Start to write; ``spark.streams.removeListener`` ends it."""
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    return log


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row for each batch."""
    rows = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(path)
    return rows.dropDuplicates(["query_id", "batch_id"])


def totals(progress: DataFrame) -> DataFrame:
    """Batches, rows and observed counts of each query over all of its batches."""
    names = F.col("observed")
    rows = progress.groupBy("query_id").agg(
        F.count("*").alias("batches"),
        F.sum("input_rows").alias("input_rows"),
        F.sum("late_rows").alias("late_rows"),
        F.max("duration_ms").alias("longest_ms"),
    )
    counts = progress.select("query_id", F.explode(names)).groupBy("query_id", "key").agg(F.sum("value").alias("value"))
    counts = counts.groupBy("query_id").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("observed"))
    return rows.join(counts, "query_id", "left")

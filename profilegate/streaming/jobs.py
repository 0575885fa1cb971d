"""Streaming jobs: validate and route, windowed counters, sliding indicators, duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from profilegate import schemas as S
from profilegate.operators import contract as C
from profilegate.operators import metrics as M
from profilegate.operators import routing as RT
from profilegate.operators import rules as R
from profilegate.options import JobOptions


def validate_log(log: DataFrame, options: JobOptions) -> DataFrame:
    """Event-log records of the created topic to checked, typed profiles with all their reasons.

    Works on streams and tables alike and stays one narrow stage: unframe, parse once, contract,
    rules. A record that is not framed or not JSON keeps its place in the log as a reject. Status, number of reasons,
    age, and the times of ingestion and processing come along.
    """
    messages = RT.unframe(log).withColumn("_topic", F.lit(options.created_topic))
    messages = C.check_messages(
        messages,
        topic="_topic",
        value="json",
        topic_contracts={options.created_topic: S.USER_CREATED_FIELDS},
        observe_as="contract",
        keep_parsed="_parsed",
    )
    profiles = C.read_created(messages, "_parsed")
    checked = C.check_profiles(
        profiles, options.today_column, country_codes=options.iso_codes, observe_as="quality"
    )
    merged = checked.withColumn(R.REASONS, merged_reasons(F.col("violations"), F.col(R.REASONS))).drop("violations", "_topic")
    return R.enrich(merged, options.today_column, F.col("timestamp") if "timestamp" in log.columns else None)


def merged_reasons(violations: Column, reasons: Column) -> Column:
    """Contract violations a declared reason does not already cover, then the declared reasons.

    Text that is no JSON object has no fields to judge and keeps that one reason.
    """
    unreadable = F.array_contains(violations, C.INVALID_JSON) | F.array_contains(violations, C.NO_CONTRACT)
    covered = {
        "source": "missing_source",
        "source_user_id": "missing_source_user_id",
        "email": ("missing_email", "invalid_email"),
        "username": "missing_username",
        "country": "missing_country",
        "country_code": "invalid_country_code",
        "date_of_birth": ("missing_date_of_birth", "invalid_date_of_birth"),
        "registered_at": "invalid_registered_at",
        "latitude": "invalid_latitude",
        "longitude": "invalid_longitude",
        "picture_large": "invalid_picture_url:picture_large",
        "picture_medium": "invalid_picture_url:picture_medium",
        "picture_thumbnail": "invalid_picture_url:picture_thumbnail",
    }
    spared = []
    for field, codes in covered.items():
        codes = (codes,) if isinstance(codes, str) else codes
        names = F.array(*[F.lit(c) for c in codes])
        spared.append(F.when(F.arrays_overlap(reasons, names), F.lit(C.VIOLATION + field)).otherwise(F.lit("")))
    kept = F.array_except(violations, F.array(*spared))
    merged = F.when(unreadable, violations).otherwise(F.array_distinct(F.concat(kept, reasons)))
    return F.when(F.size(violations) == 0, reasons).otherwise(merged)


def start_route(log: DataFrame, options: JobOptions, checkpoint: str, *, path: str | None = None, **trigger) -> StreamingQuery:
    """Validate a log stream and publish every record to its topic.

    One query feeds both topics, so the source is read once. The file sink is exactly-once, the
    Kafka sink at-least-once. Correlation headers travel along; a file sink keeps event time and quality metadata too.
    """
    checked = validate_log(log, options)
    metadata = ("timestamp", "validation_status", "reason_count", "age_years", "processed_at")
    carry = [c for c in ("headers", *(metadata if path is not None else ())) if c in checked.columns]
    routed = RT.route(checked, options, *carry)
    writer = routed.writeStream.queryName("route").option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "30 seconds"}))
    if path is None:
        return writer.format("kafka").options(**options.kafka_sink()).start()
    return writer.format("parquet").option("path", path).partitionBy("topic").start()


def windowed_counters(
    checked: DataFrame, *, ts: str = "timestamp", width: str = "1 hour", watermark: str = "10 minutes"
) -> DataFrame:
    """Rows per tumbling window, status and source; append mode emits a window once it closed."""
    rows = checked.select(F.col(ts).cast("timestamp").alias(ts), M.status().alias("validation_status"), "source")
    windowed = rows.withWatermark(ts, watermark).groupBy(F.window(ts, width), "validation_status", "source")
    return windowed.agg(F.count("*").alias("profiles"))


def sliding_success_rate(
    df: DataFrame,
    good: Column,
    *,
    ts: str,
    by: Sequence[str] = (),
    span: str = "24 hours",
    slide: str = "30 minutes",
    watermark: str = "10 minutes",
) -> DataFrame:
    """Success rate over a sliding window.

    Rows are folded to one tumbling slot each before the slots fan out to the windows that cover
    them. Windowing the rows directly would multiply every one of them, 48 times for a day by half
    hours, ahead of the shuffle.
    """
    rows = df.select(F.col(ts).cast("timestamp").alias(ts), good.alias("_good"), *by).withWatermark(ts, watermark)
    slots = rows.groupBy(F.window(ts, slide).alias("_slot"), *by).agg(
        F.count("*").alias("_total"), F.count_if("_good").alias("_good")
    )
    slots = slots.select(F.window_time("_slot").alias("_at"), "_total", "_good", *by)
    rolled = slots.groupBy(F.window("_at", span, slide), *by).agg(
        F.sum("_good").alias("good"), F.sum("_total").alias("total")
    )
    return rolled.withColumn("success_rate", F.round(F.col("good") / F.col("total"), 6))


def first_per_window(
    df: DataFrame, keys: Sequence[str], *, ts: str, width: str = "1 hour", watermark: str = "10 minutes", order: Sequence[str] = ()
) -> DataFrame:
    """Duplicates removed within tumbling windows: the first row of each key and window stays.

    Copies fold on the map side of the aggregation, so an event that was delivered a million times
    crosses the shuffle once per task.
    """
    rows = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(ts, *order)).alias("_row")
    kept = rows.groupBy(F.window(ts, width), *keys).agg(first)
    return kept.select("window", *keys, *[F.col("_row")[c].alias(c) for c in rest])


def drop_duplicates(df: DataFrame, keys: Sequence[str], *, ts: str, watermark: str = "10 minutes") -> DataFrame:
    """Duplicates within the watermark dropped row by row, without waiting for a window to close.

    Every copy travels to the task that owns its key. Prefer first_per_window() where single keys
    are flooded with copies.
    """
    rows = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    return rows.dropDuplicatesWithinWatermark(list(keys))


class JobTotals(StreamingQueryListener):
    """Totals of every streaming query of a session since ``watch()``, over all of its batches.

    A query itself remembers only its latest batches; a listener hears of each one.
    """

    def __init__(self) -> None:
        self._totals: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        self._totals.setdefault(str(event.id), {"batches": 0, "input_rows": 0, "late_rows": 0})

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        totals = self._totals.setdefault(str(progress.id), {"batches": 0, "input_rows": 0, "late_rows": 0})
        totals["batches"] += 1
        totals["input_rows"] += progress.numInputRows
        totals["late_rows"] += sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, query: StreamingQuery) -> dict[str, int]:
        """Batches, input rows and rows dropped behind the watermark, kept across restarts of the query in this session."""
        return dict(self._totals.get(str(query.id), {"batches": 0, "input_rows": 0, "late_rows": 0}))


def watch(spark: SparkSession) -> JobTotals:
    """Start to count; ``spark.streams.removeListener`` ends it."""
    totals = JobTotals()
    spark.streams.addListener(totals)
    return totals


def batch_metrics(query: StreamingQuery) -> list[dict]:
    """Per micro-batch that the query still remembers, a hundred by default: rows read and written, duration, and the observed contract and quality counts."""
    out = []
    for progress in query.recentProgress:
        row = {
            "batch_id": progress.batchId,
            "input_rows": progress.numInputRows,
            "duration_ms": progress.batchDuration,
            "sink_rows": progress.sink.numOutputRows,
        }
        for name, observed in progress.observedMetrics.items():
            row |= {f"{name}.{key}": value for key, value in observed.asDict().items()}
        out.append(row)
    return out

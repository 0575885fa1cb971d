"""Event-log records: from Kafka, or from tables of the same shape."""

from __future__ import annotations

import datetime as dt

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from profilegate import schemas as S
from profilegate.operators import views as V
from profilegate.options import JobOptions

HOUR = "hour"


def stream_kafka(spark: SparkSession, options: JobOptions, starting: str = "earliest") -> DataFrame:
    return spark.readStream.format("kafka").options(**options.kafka_source(starting=starting)).load()


def stream_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(S.EVENT_LOG_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def _millis(moment: dt.datetime) -> str:
    return str(int(moment.timestamp() * 1000))


def replay_kafka(spark: SparkSession, options: JobOptions, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Bounded batch read of [start, end); both moments need a time zone."""
    bounds = {"startingTimestamp": _millis(start), "endingTimestamp": _millis(end)}
    source = {k: v for k, v in options.kafka_source().items() if k not in ("startingOffsets", "maxOffsetsPerTrigger")}
    return spark.read.format("kafka").options(**source, **bounds).load()


def replay_files(spark: SparkSession, path: str, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """The same range from a table of records; the bounds reach the Parquet scan."""
    log = spark.read.schema(S.EVENT_LOG_SCHEMA).parquet(path)
    return log.filter((F.col("timestamp") >= F.lit(start)) & (F.col("timestamp") < F.lit(end)))


def _hour(moment: Column) -> Column:
    """The UTC hour as text, which sorts by time."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH")


def land_by_hour(records: DataFrame, path: str, load: str) -> None:
    """Keep log records by the hour of their time; the same load again replaces its records."""
    V.write_view(records.withColumn(HOUR, _hour(F.col("timestamp"))), path, [HOUR], load=load)


def hours_between(start: dt.datetime, end: dt.datetime) -> list[str]:
    """The UTC hours that [start, end) touches."""
    if start.tzinfo is None or end.tzinfo is None:
        raise ValueError("both moments need a time zone")
    hour = start.astimezone(dt.UTC).replace(minute=0, second=0, microsecond=0)
    out: list[str] = []
    while start < end and hour < end:
        out.append(hour.strftime("%Y-%m-%dT%H"))
        hour += dt.timedelta(hours=1)
    return out


def read_hours(spark: SparkSession, path: str, hours: Sequence[str]) -> DataFrame:
    """Records of some hours, which are neighbours, with their ``hour``; no directory of another hour is listed for reading."""
    log = V.read_view(spark, path)
    return log.filter(F.col(HOUR).between(hours[0], hours[-1])) if hours else log.filter(F.lit(False))


def replay(
    spark: SparkSession,
    log_path: str,
    view_path: str,
    start: dt.datetime,
    end: dt.datetime,
    process: Callable[[DataFrame], DataFrame],
    partition_by: Sequence[str] = (),
) -> list[str]:
    """Process a range of the log into a view, taking the place of whatever the range has given before.

    The range is widened to whole hours, and each hour is a load of the view: processing a range for the first time, again,
    or overlapping another leaves every record's result in the view once. ``process`` must keep ``hour``. A replay that
    dies changes nothing. Returns the hours.
    """
    hours = hours_between(start, end)
    if hours:
        V.replace_loads(process(read_hours(spark, log_path, hours)), view_path, partition_by, HOUR, hours)
    return hours

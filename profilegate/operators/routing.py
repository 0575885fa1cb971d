"""From checked profiles to event-log records and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilegate import schemas as S
from profilegate.functions import text as X
from profilegate.operators import rejects
from profilegate.operators import rules as R
from profilegate.options import JobOptions

MAGIC = bytes([0])


def encode_key(key: Column) -> Column:
    """Text to UTF-8 bytes; binary keys and nulls pass through a plain column instead."""
    return F.encode(key, "UTF-8")


def created_json() -> Column:
    """The created event as JSON: every field, nulls included, instants in UTC with ``Z``."""
    instants = ("date_of_birth", "registered_at")
    fields = [X.iso_utc(F.col(n)).alias(n) if n in instants else F.col(n) for n in S.PROFILE_FIELDS]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def invalid_json_event(user: Column) -> Column:
    return F.to_json(F.struct(*rejects.invalid_event_columns(user)), {"ignoreNullFields": "false"})


def frame(json: Column, schema_id: int) -> Column:
    """Registry wire format: a zero byte, the schema id as four big-endian bytes, the JSON text."""
    return F.concat(F.lit(MAGIC + schema_id.to_bytes(4, "big")), F.encode(json, "UTF-8"))


def unframe(df: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``schema_id`` and ``json``, both null where the bytes are not framed."""
    framed = (F.octet_length(value) >= 5) & (F.substring(value, 1, 1) == F.lit(MAGIC))
    schema_id = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("long")
    text = F.expr(f"substring(`{value}`, 6)")
    return df.withColumns(
        {"schema_id": F.when(framed, schema_id), "json": F.when(framed, F.try_validate_utf8(text.cast("string")))}
    )


def route(checked: DataFrame, options: JobOptions, *carry: str) -> DataFrame:
    """Every checked row as exactly one keyed record for the valid or the invalid topic.

    Both sides come out of one pass, with the topic in the row: a Kafka sink reads it there, a file
    sink partitions by it. Valid events are keyed on the user id, invalid ones on its pseudonym.
    """
    valid = R.is_valid()
    # The pseudonym is both key and field of a reject; it is hashed once, and for rejects only.
    user = F.col("_pseudonym")
    marked = checked.withColumn("_pseudonym", F.when(~valid, rejects.pseudonym_of_row(options.salt)))
    return marked.select(
        *carry,
        encode_key(F.when(valid, F.col("source_user_id")).otherwise(user)).alias("key"),
        F.when(valid, frame(created_json(), options.created_schema_id))
        .otherwise(frame(invalid_json_event(user), options.invalid_schema_id))
        .alias("value"),
        F.when(valid, F.lit(options.valid_topic)).otherwise(F.lit(options.invalid_topic)).alias("topic"),
    )


def correlation_headers(request_id: Column, trace_id: Column) -> Column:
    """Correlation ids as event-log headers, leaving out the ones that are not known."""
    entry = lambda name, c: F.struct(F.lit(name).alias("key"), F.encode(c, "UTF-8").alias("value"))
    both = F.array(entry("request_id", request_id), entry("trace_id", trace_id))
    return F.filter(both, lambda h: h["value"].isNotNull())


def write_log(records: DataFrame, options: JobOptions, path: str | None = None) -> None:
    """Batch write of routed records: to Kafka, or to a table partitioned by topic."""
    if path is None:
        records.write.format("kafka").options(**options.kafka_sink()).save()
    else:
        records.write.mode("append").partitionBy("topic").parquet(path)

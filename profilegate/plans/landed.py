"""Responses, messages, delivery logs and attempts as Spark derives them from the test tables.

Faults are placed by key arithmetic, so that each check has rows that fail it at every scale. JSON
kinds other than text come in through placeholders that are replaced in the finished document.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from profilegate import schemas as S
from profilegate.operators import contract as C
from profilegate.operators import routing as RT
from profilegate.operators import sli
from profilegate.plans import fixtures as FX

# The period begins in the middle of a week and of a month.
RETENTION_TODAY = dt.date(2001, 9, 12)
RETENTION_DAYS = 730
SECOND_LOAD_BELOW = "G"
# Streams of events come in parts of so many days; delayed rows in a later part.
PARTS, PART_DAYS = 8, 4
# A batch of a stream has one file for so many rows of it.
ROWS_A_FILE = 10_000
LATE_DELAY = dt.timedelta(days=6)
REPLAY_START = dt.datetime(2024, 1, 1, 6, tzinfo=dt.UTC)
REPLAY_END = dt.datetime(2024, 1, 1, 18, tzinfo=dt.UTC)

# Wire values that are no text, by key; shared with the checking SQL.
LATITUDE_JSON = (
    "CASE WHEN k % 13 = 4 THEN '97.25' WHEN k % 13 = 5 THEN '\"up\"' WHEN k % 13 = 6 THEN 'null' "
    "WHEN k % 13 = 7 THEN '-90' ELSE '48.8584' END"
)
STREET_NUMBER_JSON = (
    "CASE WHEN k % 151 = 1 THEN '42.0' WHEN k % 151 = 2 THEN '42.5' WHEN k % 151 = 3 THEN '\"42\"' "
    "WHEN k % 151 = 4 THEN 'true' WHEN k % 151 = 5 THEN 'null' ELSE CAST(street_number AS STRING) END"
)
POSTCODE_JSON = (
    "CASE WHEN k % 149 = 1 THEN '1.5' WHEN k % 149 = 2 THEN '{\"code\":\"x\"}' WHEN k % 149 = 3 THEN '1.0' "
    "WHEN k % 149 = 4 THEN '123456789012345678901234567890' WHEN k % 149 = 5 THEN 'null' "
    "WHEN k % 2 = 0 THEN postcode ELSE '\"' || postcode || '\"' END"
)


def _put(json: Column, name: str, raw: str) -> Column:
    """Replace the placeholder text of a field by raw JSON."""
    return F.replace(json, F.lit(f'"@{name}@"'), F.expr(raw))


def _hole(name: str) -> Column:
    return F.lit(f"@{name}@").alias(name)


# --- source responses -------------------------------------------------------------------------


def _source_item(suffix: str) -> Column:
    """One nested source profile; null members are left out."""
    c = F.col
    k = c("k")
    struct = F.struct
    location = struct(
        struct(_hole("street_number").alias("number"), c("street_name").alias("name")).alias("street"),
        c("city"), c("state"), c("country"), _hole("postcode"),
        F.when(k % 5 != 4, struct("latitude", "longitude")).alias("coordinates"),
        struct(c("timezone_offset").alias("offset"), c("timezone_description").alias("description")).alias("timezone"),
    )
    item = struct(
        c("gender"),
        struct(c("title"), c("first_name").alias("first"), c("last_name").alias("last")).alias("name"),
        location.alias("location"),
        F.when(k % 157 != 1, c("email")).alias("email"),
        struct(F.concat("source_user_id", F.lit(suffix)).alias("uuid"), c("username")).alias("login"),
        struct(c("date_of_birth").alias("date"), F.lit(30).alias("age")).alias("dob"),
        F.when(k % 6 != 5, struct(c("registered_at").alias("date"))).alias("registered"),
        c("phone"), c("cell"),
        F.when(k % 8 != 7, struct(c("picture_large").alias("large"), c("picture_medium").alias("medium"), c("picture_thumbnail").alias("thumbnail"))).alias("picture"),
        c("nationality").alias("nat"),
    )
    return F.to_json(item)


def responses(spark: SparkSession, folder: str) -> DataFrame:
    """Three attempts per customer, two profiles per good response."""
    p = FX.raw_profiles(spark, folder).withColumns({"first": _source_item(""), "second": _source_item("-b")})
    for n in ("first", "second"):
        filled = _put(_put(F.col(n), "postcode", POSTCODE_JSON), "street_number", STREET_NUMBER_JSON)
        p = p.withColumn(n, filled)
    second = (
        F.when(F.col("k") % 163 == 1, F.lit('"text"'))
        .when(F.col("k") % 163 == 2, F.regexp_replace("second", r'"timezone":\{[^}]*\}', '"timezone":"x"'))
        .when(F.col("k") % 163 == 3, F.regexp_replace("second", r'"timezone":\{[^}]*\}', '"timezone":null'))
        .when(F.col("k") % 163 == 4, F.regexp_replace("second", r'"uuid":"[^"]*"', '"uuid":7'))
        .otherwise(F.col("second"))
    )
    good = F.concat(F.lit('{"results":['), "first", F.lit(","), second, F.lit('],"info":{"results":2}}'))
    body = (
        F.when(F.col("k") % 167 == 1, F.lit('{"results":[]}'))
        .when(F.col("k") % 167 == 2, F.lit('{"results":{}}'))
        .when(F.col("k") % 167 == 3, F.lit('[{"results":[]}]'))
        .when(F.col("k") % 167 == 4, F.expr("substring(_good, 1, 40)"))
        .when(F.col("k") % 167 == 5, F.concat("_good", F.lit(" {}")))
        .when(F.col("k") % 167 == 6, F.lit('{"info":1}'))
        .when(F.col("k") % 167 == 7, F.concat("_good", F.lit('],[{"x":1}')))
        .when(F.col("k") % 167 == 8, F.concat("_good", F.lit("] junk")))
        .when(F.col("k") % 167 == 9, F.concat("_good", F.lit(',"x"')))
        .otherwise(F.col("_good"))
    )
    p = p.withColumn("_good", good).withColumn("_body", body)
    # What an attempt meets on its way, by key and attempt.
    p = p.withColumn("attempt", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    luck = (F.col("k") * 7 + F.col("attempt") * 3) % 11
    return p.select(
        F.concat(F.lit("r"), F.col("k").cast("string")).alias("request_id"),
        "attempt",
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("k") * 60 + F.col("attempt")).alias("requested_at"),
        (F.col("k") % 97).cast("double").alias("latency_ms"),
        F.when(F.col("k") % 173 == 1, 3).otherwise(2).alias("expected_count"),
        F.when(luck == 1, F.lit(None)).when(luck == 2, F.lit(None)).when(luck == 3, 429).when(luck == 4, 503)
        .when(luck == 5, 404).otherwise(200).cast("int").alias("status_code"),
        F.when(luck == 1, F.lit("timeout")).when(luck == 2, F.lit("connect")).alias("transport_error"),
        F.when(luck.isin(1, 2), F.lit(None)).when(luck.isin(3, 4, 5), F.lit('{"error":"x"}')).otherwise(F.col("_body")).alias("body"),
    )


# --- messages ---------------------------------------------------------------------------------


def created_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Created events as JSON text, with wire-level faults; one in 179 on a topic without contract."""
    k = F.col("k")
    holes = ("street_number", "latitude")
    fields = [_hole(n) if n in holes else F.col(n) for n in S.PROFILE_FIELDS]
    json = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    p = FX.raw_profiles(spark, folder).withColumn("value", json)
    value = _put(_put(F.col("value"), "latitude", LATITUDE_JSON), "street_number", STREET_NUMBER_JSON)
    p = p.withColumn("value", value)
    value = (
        F.when(k % 157 == 1, F.concat(F.expr("left(value, length(value) - 1)"), F.lit(',"extra":1}')))
        .when(k % 157 == 2, F.replace("value", F.lit('"email":'), F.lit('"e_mail":')))
        .when(k % 157 == 3, F.regexp_replace("value", r'"schema_version":[^,]*,', '"schema_version":1.0,'))
        .when(k % 157 == 4, F.expr("left(value, 50)"))
        .when(k % 157 == 5, F.concat(F.lit("["), "value", F.lit("]")))
        .when(k % 157 == 6, F.concat("value", F.lit(" x")))
        .when(k % 157 == 7, F.concat("value", F.lit("],[{}")))
        .when(k % 157 == 8, F.concat("value", F.lit("],\"x\"")))
        .when(k % 157 == 9, F.concat("value", F.lit("] trailing")))
        .when(k % 157 == 10, F.concat("value", F.lit(",{}")))
        .otherwise(F.col("value"))
    )
    topic = F.when(k % 179 == 1, F.lit("other_topic")).otherwise(F.lit(S.CREATED_TOPIC))
    return p.select("k", topic.alias("topic"), value.alias("value"))


def invalid_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Invalid events as JSON text, with faults in reasons, payload and pseudonym."""
    p = FX.profiles(spark, folder).select("k", "source", F.sha2(F.col("k").cast("string"), 256).alias("hash"))
    reasons = (
        "CASE k % 7 WHEN 1 THEN '[]' WHEN 2 THEN '[\"\"]' WHEN 3 THEN '[1]' ELSE '[\"missing_email\",\"implausible_age\"]' END"
    )
    payload = (
        "CASE k % 7 WHEN 4 THEN '' WHEN 5 THEN ',\"payload\":null' WHEN 6 THEN ',\"payload\":\"x\"' "
        "ELSE ',\"payload\":{\"source\":\"' || source || '\"}' END"
    )
    user = (
        "CASE k % 11 WHEN 1 THEN '\"user-1\"' WHEN 2 THEN '\"sha256:' || upper(hash) || 'F\"' WHEN 3 THEN 'null' "
        "ELSE '\"sha256:' || hash || '\"' END"
    )
    value = F.concat(
        F.lit('{"schema_version":"1.0","event_type":"UserProfileInvalid","source":"'), "source",
        F.lit('","source_user_id":'), F.expr(user), F.lit(',"rejection_reasons":'), F.expr(reasons), F.expr(payload), F.lit("}"),
    )
    return p.select("k", F.lit(S.INVALID_TOPIC).alias("topic"), value.alias("value"))


def created_log(spark: SparkSession, folder: str) -> DataFrame:
    """Created messages as log records, framed but for one in 181."""
    k = F.col("k")
    framed = RT.frame(F.col("value"), 1)
    return created_messages(spark, folder).select(
        F.encode(F.concat(F.lit("user-"), (k % 1000).cast("string")), "UTF-8").alias("key"),
        F.when(k % 181 == 1, F.encode("value", "UTF-8")).otherwise(framed).alias("value"),
        F.lit(S.CREATED_TOPIC).alias("topic"),
        (k % 4).cast("int").alias("partition"),
        k.alias("offset"),
        F.timestamp_seconds(F.lit(1_704_067_200) + k * 61).alias("timestamp"),
    )


def registered_schemas() -> list[tuple[int, str, int, str]]:
    """Two versions of the created event, of which the second takes a number ``extra`` and any latitude, and the invalid event."""
    first = C.json_schema(S.USER_CREATED_TYPE, S.USER_CREATED_FIELDS)
    second = json.loads(json.dumps(first))
    second["properties"] |= {"extra": {"type": "integer"}, "latitude": {"type": ["number", "string", "null"]}}
    other = C.json_schema(S.USER_PROFILE_INVALID_TYPE, S.USER_PROFILE_INVALID_FIELDS)
    topics = {1: (S.CREATED_TOPIC, 1, first), 2: (S.CREATED_TOPIC, 2, second), 3: (S.INVALID_TOPIC, 1, other)}
    return [(i, f"{topic}-value", version, json.dumps(schema)) for i, (topic, version, schema) in topics.items()]


def versioned_log(spark: SparkSession, folder: str) -> DataFrame:
    """Created messages framed with schema ids 1 and 2; one in 11 with an id nobody knows, one in 13 with another topic's."""
    k = F.col("k")
    schema_id = F.when(k % 11 == 1, 9).when(k % 13 == 1, 3).otherwise(1 + k % 2)
    framed = F.concat(F.lit(bytes([0])), F.unhex(F.lpad(F.hex(schema_id), 8, "0")), F.encode("value", "UTF-8"))
    messages = created_messages(spark, folder).withColumn("topic", F.lit(S.CREATED_TOPIC))
    return messages.select(F.when(k % 181 == 1, F.encode("value", "UTF-8")).otherwise(framed).alias("value"), "topic", k.alias("offset"))


# --- operations -------------------------------------------------------------------------------


def delivery_log(spark: SparkSession, folder: str) -> DataFrame:
    """One record per event in batches of twenty; every fifth batch has its own kind of trouble."""
    e = FX.table(spark, folder, "events").select("event_id", F.floor(F.col("event_id") / 20).alias("b"))
    unlucky = F.col("event_id") % 20 == 7
    kind = F.col("b") % 5
    outcome = (
        F.when(unlucky & (kind == 1), F.lit("error"))
        .when(unlucky & (kind == 2), F.lit(None))
        .when((F.col("event_id") % 20 == 3) & (kind == 2), F.lit("error"))
        .otherwise(F.lit("ack"))
    )
    return e.select(
        F.concat(F.lit("b"), F.col("b").cast("string")).alias("batch_id"),
        F.col("event_id").alias("record_id"),
        F.lit(S.CREATED_TOPIC).alias("topic"),
        outcome.alias("outcome"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.when(~(unlucky & (kind == 3)), F.col("event_id")).alias("offset"),
    )


def attempts(spark: SparkSession, folder: str) -> DataFrame:
    """Ingestion attempts read off the events: an error event is a failed call, the rest publish."""
    failed = F.col("event_type") == "error"
    reason = (
        F.when(failed & (F.col("value") > 40), F.lit("timeout"))
        .when(failed & (F.col("user_id") % 2 == 0), F.lit("http_503"))
        .when(failed, F.lit("empty_results"))
    )
    signal = (
        F.when(failed, F.lit("source_failed"))
        .when(F.col("value") > 60, F.lit("publish_failed"))
        .when(F.col("event_type") == "signup", F.lit("invalid"))
        .otherwise(F.lit("created"))
    )
    source = F.when(F.col("user_id") % 3 == 0, F.lit("crm")).otherwise(F.lit(S.DEMO_SOURCE))
    return FX.table(spark, folder, "events").select(
        source.alias("source"), reason.alias("reason"), signal.alias("signal"), "value", "ts"
    )


def hot_user_events(spark: SparkSession, folder: str) -> DataFrame:
    """Profile events, a third of which belong to one user."""
    events = FX.profile_events(spark, folder).select("source", "source_user_id", "event_id", "ingested_at", "username", "country")
    hot = F.col("event_id") % 3 == 0
    names = {"source": F.lit(S.DEMO_SOURCE), "source_user_id": F.lit("user-hot")}
    return events.withColumns({n: F.when(hot, value).otherwise(F.col(n)) for n, value in names.items()})


def _part(spark: SparkSession, events: DataFrame) -> Column:
    """The part of the stream an event's time lies in, from the first event on."""
    first = events.agg(F.min(F.unix_micros("ts"))).first()[0] or 0
    return F.least(F.floor((F.unix_micros("ts") - first) / (PART_DAYS * 86_400_000_000)), F.lit(PARTS - 1)).cast("int")


def _numbered_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the part of their time, and for two in three the part a copy of them comes in, which is the next."""
    events = FX.table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    part = _part(spark, events)
    copied = F.when((F.col("event_id") % 3 != 0) & (part < PARTS - 1), part + 1)
    return events.select("event_id", "ts", "user_id", "event_type", "value", part.alias("part"), copied.alias("copy_part"))


def _as_messages(events: DataFrame) -> DataFrame:
    cents = F.round(F.col("value") * 100).cast("long")
    number = F.concat((cents / 100).cast("decimal(18,2)").cast("string"))
    exponent = F.concat(cents.cast("string"), F.lit("e-2"))
    json = F.format_string('{"event":%d,"user":{"id":%d,"kind":"%s"},"value":%s,"tags":[1,null]}', "event_id", "user_id", "event_type", number)
    other = F.format_string('{"tags":[1.0, null], "value":%s, "user":{"kind":"%s", "id":%d.0}, "event":%d}', exponent, "event_type", "user_id", "event_id")
    return events.withColumns({"json": json, "copy_json": other}).drop("value")


def event_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Events as JSON in the part of their time, and for two in three a copy spelled otherwise, one part later."""
    return _as_messages(FX.spread(_numbered_events(spark, folder)))


def arriving_messages(spark: SparkSession, folder: str) -> Iterator[DataFrame]:
    """The rows of ``event_messages()``, events and copies, part by part; a part is dealt to as many tasks as its rows need."""
    events = _numbered_events(spark, folder)
    for part in range(PARTS):
        messages = _as_messages(FX.spread(events.filter((F.col("part") == part) | (F.col("copy_part") == part))))
        json = F.when(F.col("part") == part, F.col("json")).otherwise(F.col("copy_json"))
        yield messages.select("event_id", "ts", "user_id", "event_type", json.alias("json"))


def delayed_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events in the part of their time, one in ten a part later and one in ten three parts later."""
    events = FX.table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    delay = F.when(F.col("event_id") % 10 == 0, 1).when(F.col("event_id") % 10 == 1, 3).otherwise(0)
    part = F.least(_part(spark, events) + delay, F.lit(PARTS - 1)).cast("int")
    return events.select("event_id", "ts", "user_id", part.alias("part"))


def in_files(rows: DataFrame, path: str, n: int, number: Column) -> int:
    """Rows in ``n`` batches of equally many files, in the order of their number; returns how many files a batch has.

    A stream that takes so many files at a time reads batch by batch, since one is written after the other. The rows are
    worked out once, by as many tasks as they come in.
    """
    rows = rows.withColumn("_batch", number).persist(StorageLevel.DISK_ONLY)
    files = max(1, -(-rows.count() // (n * ROWS_A_FILE)))
    for i in range(n):
        rows.filter(F.col("_batch") == i).drop("_batch").coalesce(files).write.mode("append").parquet(path)
        # Tasks without rows write no file; empty ones take their place, so that no batch reaches into the next.
        for _ in range(files * (i + 1) - _files(rows.sparkSession, path)):
            rows.limit(0).drop("_batch").write.mode("append").parquet(path)
    rows.unpersist()
    return files


def _files(spark: SparkSession, path: str) -> int:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    entries = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return sum(not e.getPath().getName().startswith(("_", ".")) for e in entries)


def event_slots(spark: SparkSession, folder: str, step: int) -> DataFrame:
    """Good and total rows per slot for two indicators."""
    kind = F.when(F.col("user_id") % 2 == 0, F.lit("ingestion")).otherwise(F.lit("publish"))
    good = ~((F.col("event_type") == "error") & (F.col("value") > 5))
    events = FX.table(spark, folder, "events").withColumn("sli", kind)
    return sli.slot_counts(events, "ts", good, step, ["sli"])


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as a file stream, its local timestamps read as UTC."""
    schema = FX.table(spark, folder, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))

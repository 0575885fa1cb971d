"""The checked queries: each runs one or more operators over whole test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from profilegate import schemas as S
from profilegate.functions import text as X
from profilegate.functions import variants as V2
from profilegate.functions.privacy import pseudonym
from profilegate.operators import by_user
from profilegate.operators import contract as C
from profilegate.operators import delivery as D
from profilegate.operators import metrics as M
from profilegate.operators import normalize as N
from profilegate.operators import registry, rejects
from profilegate.operators import routing as RT
from profilegate.operators import rules as R
from profilegate.operators import sli
from profilegate.operators import views as V
from profilegate.operators.committed import Dates, Table
from profilegate.options import JobOptions, configure, shared_folder
from profilegate.plans import fixtures as FX
from profilegate.plans import landed as L
from profilegate.sources import event_log, responses
from profilegate.streaming import attempts, jobs, late, progress, sink, upsert

TODAY = FX.REFERENCE_DATE
OPTIONS = JobOptions(salt=FX.SALT, reference_date=TODAY)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return f(configure(spark), folder)

    QUERIES[f.__name__] = run
    return run


def joined(reasons: Column | str = R.REASONS) -> Column:
    return F.array_join(reasons, ",")


def checked_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return R.check_quality(FX.profiles(spark, folder), TODAY)


def checked_events(spark: SparkSession, folder: str) -> DataFrame:
    return R.check_quality(FX.profile_events(spark, folder), TODAY)


# --- semantic rules ---------------------------------------------------------------------------


@query
def quality_reasons(spark, folder):
    return checked_profiles(spark, folder).select("k", joined().alias("reasons"))


@query
def quality_status(spark, folder):
    status = R.with_status(checked_profiles(spark, folder), TODAY)
    return status.select("k", "validation_status", "reason_count", "age_years")


@query
def text_rules_documents(spark, folder):
    """Length and control-character rules on free text."""
    documents = FX.table(spark, folder, "documents").withColumn("text", X.strip("text"))
    rules = R.with_reasons(documents, R.text_rules("text", S.MAX_TEXT_LENGTH))
    return rules.select("doc_id", F.length("text").alias("chars"), joined().alias("reasons"))


# --- structural contract ----------------------------------------------------------------------


@query
def contract_strip_required(spark, folder):
    p = R.prepare(FX.raw_profiles(spark, folder))
    required = [f.name for f in S.USER_CREATED_FIELDS if f.required]
    missing = F.concat_ws(",", *[F.when(F.coalesce(F.col(n).cast("string"), F.lit("")) == "", F.lit(n)) for n in required])
    return p.select(
        "k", "source", "first_name", "country_code", missing.alias("missing"),
        F.coalesce(F.length("country_code") == 2, F.lit(True)).alias("code_length_ok"),
    )


@query
def contract_email(spark, folder):
    p = R.prepare(FX.raw_profiles(spark, folder))
    return p.select("k", "email", X.valid_email(F.col("email")).alias("ok"))


@query
def contract_coordinates(spark, folder):
    p = R.prepare(FX.raw_profiles(spark, folder))
    return p.select(
        "k",
        F.col(R.LATITUDE).alias("latitude"),
        (F.col("latitude").isNull() | X.in_bounds(F.col(R.LATITUDE), -90.0, 90.0)).alias("latitude_ok"),
        (F.col("longitude").isNull() | X.in_bounds(F.col(R.LONGITUDE), -180.0, 180.0)).alias("longitude_ok"),
    )


@query
def contract_datetime(spark, folder):
    p = R.prepare(FX.raw_profiles(spark, folder))
    return p.select(
        "k", F.unix_micros(R.BIRTH).alias("born_us"), F.unix_micros(R.REGISTERED).alias("registered_us")
    )


@query
def contract_url(spark, folder):
    p = R.prepare(FX.raw_profiles(spark, folder)).select(
        F.concat(F.lit("profile-"), "k").alias("id"), F.col("picture_large").alias("url")
    )
    pages = FX.table(spark, folder, "pages").select(F.concat(F.lit("page-"), "page_id").alias("id"), "url")
    url = F.col("url")
    return p.unionByName(pages).select(
        "id", X.valid_http_url(url).alias("http_ok"), X.valid_https_url(url, S.MAX_URL_LENGTH).alias("https_ok")
    )


@query
def contract_profiles(spark, folder):
    """All structural and semantic reasons of text profiles."""
    return C.check_profiles(FX.raw_profiles(spark, folder), TODAY).select("k", joined().alias("reasons"))


@query
def contract_extra_fields(spark, folder):
    messages = L.created_messages(spark, folder)
    envelope = [C.UNKNOWN_FIELDS, C.VIOLATION + "schema_version", C.VIOLATION + "event_type"]
    flags = [F.array_contains("violations", v).alias(v.split(":")[1]) for v in envelope]
    return C.check_messages(messages).select("k", *flags)


@query
def contract_conformance(spark, folder):
    """Messages of both topics and of one without a contract."""
    messages = L.created_messages(spark, folder).unionByName(L.invalid_messages(spark, folder))
    out = C.check_messages(messages).withColumn("subject", C.subject("topic"))
    return out.select("k", "topic", "subject", joined("violations").alias("violations"))


# --- source responses -------------------------------------------------------------------------


@query
def normalize_profiles(spark, folder):
    classified = N.classify_responses(L.responses(spark, folder))
    # Correlation columns travel along.
    return N.explode_profiles(classified, "request_id", "attempt")


@query
def classify_responses(spark, folder):
    classified = N.classify_responses(L.responses(spark, folder))
    return classified.select("request_id", "attempt", F.coalesce("reason", F.lit("ok")).alias("reason"), "retryable")


@query
def response_scan(spark, folder):
    """Landed responses, one request in 191 asking for nothing, by what became of them."""
    path = shared_folder(spark) + "/responses"
    count = F.when(F.expr("CAST(substring(request_id, 2) AS BIGINT) % 191 = 1"), 0).otherwise(F.col("expected_count"))
    L.responses(spark, folder).withColumn("expected_count", count).write.parquet(path)
    classified = N.classify_responses(responses.read_responses(spark, path))
    outcome = F.coalesce("reason", F.lit("ok")).alias("reason")
    return classified.groupBy(outcome, "retryable").agg(F.count("*").alias("attempts"))


@query
def resolve_attempts(spark, folder):
    return N.resolve_attempts(N.classify_responses(L.responses(spark, folder)), 2)


@query
def country_code_lookup(spark, folder):
    p = FX.profiles(spark, folder)
    return p.select("k", "country", N.country_code(F.col("country")).alias("derived_code"))


# --- privacy and routing ----------------------------------------------------------------------


@query
def pseudonymize(spark, folder):
    p = FX.profiles(spark, folder)
    return p.select("k", pseudonym(F.col("source"), F.col("source_user_id"), FX.SALT).alias("pseudonym"))


@query
def invalid_events(spark, folder):
    events = rejects.invalid_events(checked_profiles(spark, folder), FX.SALT)
    payload = [F.col("payload")[n].alias(f"payload_{n}") for n in S.PAYLOAD_FIELDS]
    return events.select("schema_version", "event_type", "source", "source_user_id", joined().alias("reasons"), *payload)


@query
def valid_events(spark, folder):
    """The typed event of every profile without a reason."""
    events = rejects.valid_events(C.check_profiles(FX.raw_profiles(spark, folder), TODAY))
    return events.withColumns({n: F.unix_micros(n) for n in ("date_of_birth", "registered_at")})


@query
def route_topics(spark, folder):
    routed = RT.route(C.check_profiles(FX.profiles(spark, folder), TODAY), OPTIONS, "k")
    text = RT.unframe(routed)
    return text.select(
        "k",
        "topic",
        F.decode("key", "UTF-8").alias("key"),
        "schema_id",
        *[F.get_json_object("json", f"$.{n}").alias(n) for n in ("event_type", "source_user_id", "date_of_birth", "latitude")],
        F.size(F.json_object_keys("json")).alias("fields"),
    )


@query
def frame_roundtrip(spark, folder):
    p = FX.profiles(spark, folder)
    json = F.to_json(F.struct("source_user_id", "first_name", "phone"), {"ignoreNullFields": "false"})
    # Every seventh frame loses its magic byte.
    value = RT.frame(json, 70_000)
    broken = F.concat(F.lit(bytes([1])), F.expr("substring(value, 2)"))
    framed = p.select("k", value.alias("value")).withColumn("value", F.when(F.col("k") % 7 == 0, broken).otherwise(F.col("value")))
    back = RT.unframe(framed)
    fields = [F.get_json_object("json", f"$.{n}").alias(n) for n in ("source_user_id", "first_name", "phone")]
    return back.select("k", F.octet_length("value").alias("bytes"), "schema_id", *fields)


@query
def delivery_outcome(spark, folder):
    return D.delivery_outcome(L.delivery_log(spark, folder))


@query
def delivery_outcome_single(spark, folder):
    single = L.delivery_log(spark, folder).withColumn("batch_id", F.concat(F.lit("r"), "record_id"))
    return D.delivery_outcome(single, single=True).groupBy("result").agg(F.count("*").alias("publications"))


@query
def unacknowledged_records(spark, folder):
    log = L.delivery_log(spark, folder)
    return D.unacknowledged_records(log.select("batch_id", "record_id"), log)


# --- counters and signals ---------------------------------------------------------------------


@query
def counters_status(spark, folder):
    return M.status_counts(checked_profiles(spark, folder))


@query
def counters_reason(spark, folder):
    return M.reason_counts(checked_profiles(spark, folder))


@query
def counters_all(spark, folder):
    return M.quality_counters(checked_events(spark, folder))


@query
def counters_rollup(spark, folder):
    return M.status_rollup(checked_profiles(spark, folder))


@query
def profiles_by_country(spark, folder):
    return V.profiles_by_country(checked_profiles(spark, folder))


@query
def failures_by_reason(spark, folder):
    return M.failures_by_reason(L.attempts(spark, folder), ["source"])


@query
def latency_summary(spark, folder):
    """Exact p50, p95 and p99 per kind of call."""
    return M.exact_percentiles(FX.table(spark, folder, "events"), "value", [500, 950, 990], ["event_type"])


@query
def latency_histogram(spark, folder):
    rows = M.latency_histogram(FX.table(spark, folder, "events"), "value", ["event_type"])
    return rows.withColumn("upper_bound", F.col("upper_bound").cast("string"))


@query
def signal_totals(spark, folder):
    return M.signal_totals(L.attempts(spark, folder), ["source"])


@query
def success_rate_24h(spark, folder):
    return sli.success_rate(L.event_slots(spark, folder, 1800), ["sli"], step=1800)


@query
def invalid_without_reason(spark, folder):
    return M.invalid_without_reason(rejects.invalid_events(checked_profiles(spark, folder), FX.SALT))


@query
def burn_rate_alerts(spark, folder):
    return sli.burn_rate_alerts(L.event_slots(spark, folder, 1800), ["sli"], step=1800, span=7200)


@query
def p99_alerts(spark, folder):
    events = FX.table(spark, folder, "events")
    return sli.p99_alerts(events, "ts", "value", ["event_type"], threshold=60.0, step=7200, span=28800)


# --- views ------------------------------------------------------------------------------------


@query
def latest_valid(spark, folder):
    rows = V.latest_valid(checked_events(spark, folder), 100, tie=("event_id",))
    return rows.select("event_id", F.unix_micros("ingested_at").alias("ingested_us"), "source_user_id", "country")


@query
def latest_per_user(spark, folder):
    rows = V.latest_per_key(FX.profile_events(spark, folder), V.USER_KEY, ["ingested_at", "event_id"])
    return rows.select(*V.USER_KEY, "event_id", F.unix_micros("ingested_at").alias("ingested_us"), "username")


@query
def invalid_by_reason_time(spark, folder):
    """The three newest rejects of every reason."""
    invalid = rejects.invalid_events(checked_events(spark, folder), FX.SALT, "event_id", "ingested_at")
    by_reason = V.invalid_by_reason(invalid, "ingested_at", "event_id", "source_user_id")
    top = V.latest_invalid_by_reason(by_reason, 3, "ingested_at", ("event_id",))
    return top.select("reason", "rank", "event_id", F.unix_micros("ingested_at").alias("processed_us"), "source_user_id")


@query
def view_partitioned(spark, folder):
    """Valid profile events by country in two loads; the first is loaded again with fewer rows and countries."""
    path = shared_folder(spark) + "/valid_by_country"
    events = rejects.valid_events(C.check_profiles(FX.profile_events(spark, folder), TODAY), "event_id", "ingested_at")
    even = F.col("event_id") % 2 == 0
    for load, part in (("a", even), ("b", ~even), ("a", even & (F.col("country") < L.SECOND_LOAD_BELOW))):
        V.write_view(events.filter(part), path, ["country"], load=load)
    return V.read_view(spark, path, loads=True).select("event_id", "source_user_id", "country", "load_id")


@query
def view_latest_valid(spark, folder):
    """Valid events laid out by month of ingestion; the newest of every month."""
    path = shared_folder(spark) + "/latest_valid"
    V.write_latest_valid(C.check_profiles(FX.profile_events(spark, folder), TODAY), path, "ingested_at", "event_id", unit="month")
    view = V.read_view(spark, path)
    return view.groupBy("event_date").agg(F.count("*").alias("events"), F.max(F.struct("ingested_at", "event_id")).alias("m")).select(
        "event_date", "events", F.col("m.event_id").alias("newest"))


@query
def view_invalid_by_reason(spark, folder):
    """Rejects laid out by reason and month."""
    path = shared_folder(spark) + "/by_reason"
    invalid = rejects.invalid_events(checked_events(spark, folder), FX.SALT, "event_id", "ingested_at")
    V.write_invalid_by_reason(invalid, path, "ingested_at", "event_id", unit="month")
    return V.read_view(spark, path).select("reason", "event_date", "event_id")


@query
def view_counters(spark, folder):
    """Counters laid out by month."""
    path = shared_folder(spark) + "/counters"
    V.write_counters(checked_events(spark, folder), path, "ingested_at", unit="month")
    return V.read_view(spark, path).select("event_date", "validation_status", "source", "profiles")


@query
def retention(spark, folder):
    """Rejects in two loads, by load, source and month, after all rows beyond the retention period were removed."""
    path = shared_folder(spark) + "/rejects"
    invalid = rejects.invalid_events(checked_events(spark, folder), FX.SALT, "event_id", "ingested_at")
    rows = V.dated(invalid.select("source", "event_id", "ingested_at"), "ingested_at", "month")
    for load in range(2):
        part = rows.filter(F.col("event_id") % 2 == load)
        V.write_view(part, path, ["source", "event_date"], load=f"load {load}", dates=Dates(unit="month", ts="ingested_at"))
    V.expire(spark, path, L.RETENTION_TODAY, L.RETENTION_DAYS)
    return V.read_view(spark, path, loads=True).select("load_id", "source", "event_id", F.to_date("ingested_at").alias("day"))


@query
def retention_on_read(spark, folder):
    """Rejects of the retention period, from a view by week that has older ones."""
    path = shared_folder(spark) + "/rejects"
    invalid = rejects.invalid_events(checked_events(spark, folder), FX.SALT, "event_id", "ingested_at")
    dates = Dates(unit="week", ts="ingested_at")
    V.write_view(V.dated(invalid.select("event_id", "ingested_at"), "ingested_at", "week"), path, ["event_date"], dates=dates)
    view = V.retained(V.read_view(spark, path), L.RETENTION_TODAY, L.RETENTION_DAYS, dates)
    return view.select("event_id", F.to_date("ingested_at").alias("day"))


@query
def retention_of_counters(spark, folder):
    """Monthly counters, whose rows have no day of their own: a month stays until all of it is beyond the period."""
    path = shared_folder(spark) + "/counters"
    V.write_counters(checked_events(spark, folder), path, "ingested_at", unit="month")
    V.expire(spark, path, L.RETENTION_TODAY, L.RETENTION_DAYS)
    return V.read_view(spark, path).select("event_date", "validation_status", "source", "profiles")


@query
def newest_by_user(spark, folder):
    """The newest event of each user and year, dealt out by user, of whom one owns a third of all rows."""
    events = L.hot_user_events(spark, folder).withColumn("year", F.year("ingested_at"))
    path = shared_folder(spark) + "/events"
    events.write.parquet(path)
    newest = by_user.newest_by_user(spark.read.parquet(path), ["ingested_at", "event_id"], 16, within=["year"])
    return newest.select(*V.USER_KEY, "year", "event_id", "username")


# --- streams ----------------------------------------------------------------------------------


def _drain(streaming: DataFrame, base: str) -> str:
    """Run a stream over everything that is there and leave its output as a table."""
    writer = streaming.writeStream.outputMode("append").option("checkpointLocation", base + "/checkpoint")
    writer.format("parquet").option("path", base + "/out").trigger(availableNow=True).start().awaitTermination()
    return base + "/out"


@query
def stream_counters(spark, folder):
    checked = L.event_stream(spark, folder).select(
        "ts",
        F.col("event_type").alias("source"),
        F.when(F.col("event_type") == "error", F.array(F.lit("source_failed"))).otherwise(F.array().cast("array<string>")).alias(R.REASONS),
    )
    counters = jobs.windowed_counters(checked, ts="ts", width="6 hours")
    out = counters.select(F.unix_micros("window.start").alias("window_us"), "validation_status", "source", "profiles")
    return spark.read.schema(out.schema).parquet(_drain(out, shared_folder(spark)))


@query
def stream_sliding_sli(spark, folder):
    rates = jobs.sliding_success_rate(L.event_stream(spark, folder), F.col("event_type") != "error", ts="ts")
    out = rates.select(F.unix_micros("window.start").alias("window_us"), "good", "total", "success_rate")
    return spark.read.schema(out.schema).parquet(_drain(out, shared_folder(spark)))


@query
def stream_dedupe(spark, folder):
    events = L.event_stream(spark, folder).select("event_id", "ts", "user_id", "event_type")
    first = jobs.first_per_window(events, ["user_id", "event_type"], ts="ts", width="1 day", order=["event_id"])
    out = first.select(F.unix_micros("window.start").alias("window_us"), "user_id", "event_type", "event_id")
    return spark.read.schema(out.schema).parquet(_drain(out, shared_folder(spark)))


@query
def stream_exactly_once(spark, folder):
    """Events with copies whose JSON is spelled otherwise, one batch after them and after a restart: each comes out once."""
    base = shared_folder(spark)
    for rows in L.arriving_messages(spark, folder):
        rows.write.mode("append").parquet(base + "/events")
        # A batch for each part, however many files it has, and a restart after it. Copies are within the watermark.
        stream = spark.readStream.schema("event_id long, ts timestamp, user_id long, event_type string, json string").parquet(base + "/events")
        hashed = stream.withColumn("payload", V2.payload_hash(F.col("json")))
        once = jobs.drop_duplicates(hashed, ["user_id", "event_type", "payload"], ts="ts", watermark=f"{3 * L.PART_DAYS} days")
        _drain(once.select("event_id", "user_id", "event_type"), base)
    return spark.read.schema("event_id long, user_id long, event_type string").parquet(base + "/out")


@query
def payload_hashes(spark, folder):
    """Whether differently spelled JSON of an event has one hash, and that of another event a different one."""
    hashed = L.event_messages(spark, folder).select(
        "event_id", V2.payload_hash(F.col("json")).alias("one"), V2.payload_hash(F.col("copy_json")).alias("two"), F.sha2("json", 256).alias("plain")
    )
    copies = hashed.groupBy("one").agg(F.count("*").alias("events"), F.min("event_id").alias("event_id"), F.bool_and(F.col("one") == F.col("two")).alias("same"))
    return copies.select("event_id", "events", "same")


@query
def stream_late_rows(spark, folder):
    """On time and late rows of every batch of a stream, of which some come one and three batches after their time."""
    base = shared_folder(spark)
    events = L.delayed_events(spark, folder)
    files = L.in_files(events, base + "/events", L.PARTS, F.col("part"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(base + "/events")
    late.start_split(stream, base + "/split", base + "/checkpoint", ts="ts", delay=L.LATE_DELAY, availableNow=True).awaitTermination()
    rows = late.read_split(spark, base + "/split")
    return rows.groupBy(F.col("batch_id").alias("batch"), "side").agg(F.count("*").alias("events"), F.sum("event_id").alias("ids"))


@query
def stream_recovery(spark, folder):
    """The whole job over six batches, with a crash before the commit of one and another after the commit of the next."""
    base = shared_folder(spark)
    files = L.in_files(L.created_log(spark, folder), base + "/log", 6, F.pmod(F.col("offset"), F.lit(6)))
    crashes = {("written", 1), ("committed", 3)}

    def crash(step: str, batch_id: int) -> None:
        if (step, batch_id) in crashes:
            crashes.remove((step, batch_id))
            raise RuntimeError(f"crash: {step} {batch_id}")

    starts = 0
    while True:
        log = event_log.stream_files(spark, base + "/log", max_files=files)
        routed = RT.route(jobs.validate_log(log, OPTIONS), OPTIONS, "validation_status", "reason_count")
        starts += 1
        job = sink.start_table(routed, base + "/out", base + "/checkpoint", partition_by=["topic"], on_step=crash, availableNow=True)
        try:
            job.awaitTermination()
            break
        except StreamingQueryException as error:
            if "crash: " not in str(error) or starts > 3:
                raise
    if starts != 3:
        raise RuntimeError(f"the job should have started three times, not {starts}")
    return _routed_columns(Table(spark, base + "/out").read())


@query
def stream_progress(spark, folder):
    """Metrics of 120 batches over a restart, and the counts observed in them."""
    base = shared_folder(spark)
    events = FX.table(spark, folder, "events").select("event_id", "event_type", F.pmod("event_id", F.lit(120)).alias("n"))
    log = progress.log_progress(spark, base + "/progress")
    try:
        for part in (F.col("n") < 90, F.col("n") >= 90):
            # A file, and so a batch, for each number.
            events.filter(part).repartition("n").write.mode("append").partitionBy("n").parquet(base + "/events")
            stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(base + "/events")
            counted = stream.observe("events", F.count(F.lit(1)).alias("rows"), F.count_if(F.col("event_type") == "error").alias("errors"))
            writer = counted.writeStream.format("noop").option("checkpointLocation", base + "/checkpoint").queryName("counted")
            job = writer.trigger(availableNow=True).start()
            job.awaitTermination()
            log.wait(job)
    finally:
        spark.streams.removeListener(log)
    totals = progress.totals(progress.read_progress(spark, base + "/progress"))
    observed = [F.col("observed")[f"events.{n}"].alias(n) for n in ("rows", "errors")]
    return totals.select("batches", "input_rows", "late_rows", *observed)


@query
def stream_attempts(spark, folder):
    """Requests resolved from attempts that come in four batches, out of order."""
    base = shared_folder(spark)
    number = F.pmod(F.hash("request_id", "attempt"), F.lit(4))
    files = L.in_files(L.responses(spark, folder), base + "/responses", 4, number)
    stream = responses.stream_responses(spark, base + "/responses", max_files=files)
    out = attempts.resolve_stream(N.classify_responses(stream), 2, timeout="3650 days")
    return spark.read.schema(attempts.OUTPUT).parquet(_drain(out, base)).select("request_id", "outcome", "attempts_made")


@query
def stream_route(spark, folder):
    """Framed messages through the whole job: contract, rules, reasons, topics."""
    base = shared_folder(spark)
    L.created_log(spark, folder).write.parquet(base + "/log")
    log = event_log.stream_files(spark, base + "/log")
    query = jobs.start_route(log, OPTIONS, base + "/checkpoint", path=base + "/out", availableNow=True)
    query.awaitTermination()
    return _routed_columns(spark.read.parquet(base + "/out"))


def _routed_columns(records: DataFrame) -> DataFrame:
    return RT.unframe(records).select(
        "topic",
        F.decode("key", "UTF-8").alias("key"),
        F.get_json_object("json", "$.rejection_reasons").alias("reasons"),
        F.get_json_object("json", "$.username").alias("username"),
        "validation_status",
        "reason_count",
    )


@query
def replay_range(spark, folder):
    """A bounded re-read of the log, folded to the newest event per user."""
    path = shared_folder(spark) + "/log"
    L.created_log(spark, folder).write.parquet(path)
    bounded = event_log.replay_files(spark, path, L.REPLAY_START, L.REPLAY_END)
    newest = V.latest_per_key(bounded.select("key", "timestamp", "offset"), ["key"], ["timestamp", "offset"])
    return newest.select(F.decode("key", "UTF-8").alias("key"), F.unix_micros("timestamp").alias("at_us"), "offset")


@query
def replay_twice(spark, folder):
    """The job over a log by hours, then twice over overlapping ranges of it again: every record's result is there once."""
    base = shared_folder(spark)
    log = L.created_log(spark, folder).persist()
    start, end = log.agg(F.min("timestamp"), F.max("timestamp")).first()
    event_log.land_by_hour(log, base + "/log", "all")
    log.unpersist()

    def process(records: DataFrame) -> DataFrame:
        return RT.route(jobs.validate_log(records, OPTIONS), OPTIONS, "validation_status", "reason_count", event_log.HOUR)

    whole = (start.astimezone(dt.UTC), end.astimezone(dt.UTC) + dt.timedelta(seconds=1))
    for bounds in (whole, (L.REPLAY_START, L.REPLAY_END), (L.REPLAY_START + dt.timedelta(hours=5), L.REPLAY_END)):
        event_log.replay(spark, base + "/log", base + "/view", *bounds, process, ["topic"])
    return _routed_columns(V.read_view(spark, base + "/view"))


@query
def contract_by_schema_id(spark, folder):
    """Framed messages of two versions of a contract, of a schema of another topic, and of one nobody registered."""
    path = shared_folder(spark) + "/registry"
    spark.createDataFrame(L.registered_schemas(), registry.COLUMNS).write.parquet(path)
    contracts = registry.read_registry(spark, path)
    checked = registry.check_framed(L.versioned_log(spark, folder), contracts)
    return checked.select(F.col("offset").alias("k"), "schema_id", joined("violations").alias("violations"))


@query
def latency_sketches(spark, folder):
    """Percentiles from sketches stored by six hours, merged over all: whether their rank is as exact as is said."""
    path = shared_folder(spark) + "/sketches"
    events = FX.table(spark, folder, "events")
    slots = events.withColumn("slot", F.window(F.col("ts").cast("timestamp"), "6 hours")["start"])
    M.quantile_sketches(slots, "value", ["event_type", "slot"]).write.parquet(path)
    merged = M.merged_percentiles(spark.read.parquet(path), [500, 950, 990], ["event_type"])
    found = merged.withColumnsRenamed({"event_type": "kind", "value": "quantile"})
    ranked = events.join(found, F.col("event_type") == F.col("kind")).groupBy("event_type", "per_mille", "rows").agg(
        F.count_if(F.col("value") < F.col("quantile")).alias("below"), F.count_if(F.col("value") <= F.col("quantile")).alias("upto")
    )
    # Beyond twice the error that 99 % of ranks keep to is out of the question.
    most = 2 * M.rank_error() * F.col("rows") + 1
    wanted = F.col("rows") * F.col("per_mille") / 1000
    return ranked.select("event_type", "per_mille", "rows", wanted.between(F.col("below") - most, F.col("upto") + most).alias("within"))


@query
def stream_upsert(spark, folder):
    """The newest event of each user and month, from a stream of ten batches whose months are merged on the way."""
    base = shared_folder(spark)
    events = L.hot_user_events(spark, folder)
    files = L.in_files(events, base + "/events", 10, F.pmod(F.hash("event_id"), F.lit(10)))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(base + "/events")
    keys, order = list(V.USER_KEY), ["ingested_at", "event_id"]
    query = upsert.start_upsert(
        stream.withColumn("ingested_month", F.trunc("ingested_at", "month")), base + "/view", base + "/checkpoint",
        keys=keys, order=order, ts="ingested_month", compact_every=4, most=2, availableNow=True,
    )
    query.awaitTermination()
    rows = upsert.current_rows(spark, base + "/view", keys, order)
    return rows.select(*keys, "event_date", "event_id")

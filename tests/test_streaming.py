import datetime as dt
import json

import pytest
from people import TODAY, frame
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from profilegate import schemas as S
from profilegate.functions import variants
from profilegate.operators import contract as C
from profilegate.operators import normalize
from profilegate.operators import routing as RT
from profilegate.operators import rules as R
from profilegate.operators import views as V
from profilegate.operators.committed import Table
from profilegate.options import JobOptions, shared_folder
from profilegate.sources import event_log
from profilegate.streaming import attempts, jobs, late, progress, sink, upsert

OPTIONS = JobOptions(salt="pepper", reference_date=TODAY)
NOON = dt.datetime(2024, 5, 1, 12, tzinfo=dt.UTC)
CHANGES = [{}, {"username": ""}, {"country": "Ruritania"}, {"email": "nobody"}, {"timezone_offset": "+16:30"}]


def message(i, change, **wire):
    from people import GOOD

    event = {"schema_version": "1.0", "event_type": "UserCreated"} | GOOD | {"latitude": 53.3, "longitude": -6.2}
    event |= {"source_user_id": f"id-{i}"} | change | wire
    return b"\x00\x00\x00\x00\x01" + json.dumps(event).encode()


def write_log(spark, path, values, first=0, step=1):
    rows = [(b"k", v, S.CREATED_TOPIC, 0, first + i, NOON + dt.timedelta(minutes=(first + i) * step)) for i, v in enumerate(values)]
    spark.createDataFrame(rows, S.EVENT_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_job_routes_every_record_with_its_reasons(spark, tmp_path):
    values = [message(i, c) for i, c in enumerate(CHANGES)]
    values += [b"junk", b"\x00\x00\x00\x00\x01[]", message(7, {}, extra=1), message(8, {}, latitude="north"), message(9, {"first_name": ""})]
    write_log(spark, str(tmp_path / "log"), values)
    log = event_log.stream_files(spark, str(tmp_path / "log"))
    query = jobs.start_route(log, OPTIONS, str(tmp_path / "cp"), path=str(tmp_path / "out"), availableNow=True)
    query.awaitTermination()
    back = RT.unframe(spark.read.parquet(str(tmp_path / "out"))).orderBy("timestamp").collect()
    reasons = [json.loads(r.json).get("rejection_reasons") for r in back]
    assert reasons == [
        None, ["missing_username"], ["unsupported_country"], ["invalid_email"], ["invalid_timezone_offset"],
        ["invalid_json"], ["invalid_json"], ["contract_violation:additional_properties"],
        ["contract_violation:latitude"], ["contract_violation:first_name"],
    ]
    assert [r.topic == S.VALID_TOPIC for r in back] == [r is None for r in reasons]
    observed = jobs.batch_metrics(query)
    assert observed[0]["quality.rows"] == 10 and observed[0]["contract.violating"] >= 4 and observed[0]["input_rows"] == 10


def test_stream_equals_batch_and_survives_restarts(spark, tmp_path):
    log_path, out, cp = (str(tmp_path / n) for n in ("log", "out", "cp"))
    for start in (0, 40, 80):
        write_log(spark, log_path, [message(i, CHANGES[i % 5]) for i in range(start, start + 40)], start)
        stream = event_log.stream_files(spark, log_path, max_files=1)
        jobs.start_route(stream, OPTIONS, cp, path=out, availableNow=True).awaitTermination()
    batch = RT.route(jobs.validate_log(spark.read.parquet(log_path), OPTIONS), OPTIONS, "timestamp")
    columns = ["timestamp", "key", "value", "topic"]
    streamed = [tuple(r) for r in spark.read.parquet(out).select(*columns).orderBy("timestamp").collect()]
    assert streamed == [tuple(r) for r in batch.select(*columns).orderBy("timestamp").collect()]
    assert len(streamed) == 120


def run(spark, df, tmp_path, name, mode="append"):
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", str(tmp_path / f"cp-{name}"))
    query = writer.format("parquet").option("path", str(tmp_path / name)).trigger(availableNow=True).start()
    query.awaitTermination()
    return query, spark.read.schema(df.schema).parquet(str(tmp_path / name))


def ticks(spark, path, minutes, kind="a", first=0):
    rows = [(first + i, NOON + dt.timedelta(minutes=m), kind, 1.0) for i, m in enumerate(minutes)]
    spark.createDataFrame(rows, "n long, ts timestamp, kind string, v double").coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema("n long, ts timestamp, kind string, v double").option("maxFilesPerTrigger", 1).parquet(path)


def test_counters_emit_closed_windows_and_drop_late_rows(spark, tmp_path):
    totals = jobs.watch(spark)
    path = str(tmp_path / "in")
    stream = ticks(spark, path, [0, 5, 59, 130])
    checked = lambda s: s.select("ts", F.col("kind").alias("source"), F.array().cast("array<string>").alias(R.REASONS))
    _, out = run(spark, jobs.windowed_counters(checked(stream), ts="ts"), tmp_path, "counters")
    assert [(r.window.start.hour, r.profiles) for r in out.orderBy("window").collect()] == [(12, 3)]
    stream = ticks(spark, path, [10, 250], first=10)  # the first one is long gone
    query, out = run(spark, jobs.windowed_counters(checked(stream), ts="ts"), tmp_path, "counters")
    assert [(r.window.start.hour, r.profiles) for r in out.orderBy("window").collect()] == [(12, 3), (14, 1)]
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    assert totals.of(query)["late_rows"] == 1 and totals.of(query)["batches"] >= 2
    spark.streams.removeListener(totals)


def test_copies_fold_to_the_first_row_of_a_window(spark, tmp_path):
    stream = ticks(spark, str(tmp_path / "in"), [0, 0, 0, 1, 61, 62, 200])
    first = jobs.first_per_window(stream, ["kind"], ts="ts", order=["n"])
    plan = jobs.first_per_window(spark.range(1).selectExpr("id AS n", "timestamp_seconds(id) AS ts", "'a' AS kind"), ["kind"], ts="ts")
    assert "partial_min_by" in plan._jdf.queryExecution().executedPlan().toString()
    _, out = run(spark, first, tmp_path, "first")
    assert sorted(r.n for r in out.collect()) == [0, 4]


def test_duplicates_within_the_watermark(spark, tmp_path):
    path = str(tmp_path / "in")
    stream = ticks(spark, path, [0, 1, 2])
    ticks(spark, path, [3], kind="b", first=5)
    ticks(spark, path, [4], first=9)
    _, out = run(spark, jobs.drop_duplicates(stream, ["kind"], ts="ts"), tmp_path, "dd")
    assert sorted(r.kind for r in out.collect()) == ["a", "b"]


def test_sliding_rate_equals_windowing_the_rows(spark, tmp_path):
    minutes = [i * 7 for i in range(400)]
    stream = ticks(spark, str(tmp_path / "in"), minutes)
    good = F.col("n") % 4 != 0
    rates = jobs.sliding_success_rate(stream, good, ts="ts", span="6 hours", slide="30 minutes")
    _, out = run(spark, rates, tmp_path, "rates")
    got = {r.window.start: (r.good, r.total) for r in out.collect()}
    rows = spark.read.parquet(str(tmp_path / "in"))
    direct = rows.groupBy(F.window("ts", "6 hours", "30 minutes")).agg(F.count_if(good).alias("g"), F.count("*").alias("t"))
    closed = NOON + dt.timedelta(minutes=minutes[-1] - 10)
    want = {r.window.start: (r.g, r.t) for r in direct.collect() if r.window.end.replace(tzinfo=dt.UTC) <= closed}
    assert got == want and len(got) > 80


def test_upsert_is_idempotent_over_replayed_batches(spark, tmp_path):
    path, keys, order = str(tmp_path / "view"), ["kind"], ["ts", "n"]
    one = spark.createDataFrame([(1, NOON, "a"), (2, NOON, "a"), (3, NOON, "b")], "n long, ts timestamp, kind string")
    two = spark.createDataFrame([(4, NOON + dt.timedelta(hours=1), "a"), (5, NOON + dt.timedelta(days=1), "b")], one.schema)
    for query_id, batch_id, batch in (("q", 0, one), ("q", 1, two), ("q", 1, two), ("q", 0, one), ("r", 0, two)):
        upsert.write_batch(batch.withColumn("event_date", F.to_date("ts")), query_id, batch_id, path, keys, order, "event_date")
    rows = upsert.current_rows(spark, path, keys, order).orderBy("kind", "event_date").collect()
    assert [(r.kind, r.event_date.day, r.n) for r in rows] == [("a", 1, 4), ("b", 1, 3), ("b", 2, 5)]
    whole = upsert.current_rows(spark, path, keys, order, per_day=False).orderBy("kind").collect()
    assert [(r.kind, r.n) for r in whole] == [("a", 4), ("b", 5)]
    assert Table(spark, path).read().count() == 6  # the second query has directories of its own


def test_upsert_stream_restarts(spark, tmp_path):
    src, view, cp = (str(tmp_path / n) for n in ("in", "view", "cp"))
    for first in (0, 10):
        stream = ticks(spark, src, [0, 1, 2], first=first)
        upsert.start_upsert(stream, view, cp, keys=["kind"], order=["ts", "n"], ts="ts", availableNow=True).awaitTermination()
    assert [r.n for r in upsert.current_rows(spark, view, ["kind"], ["ts", "n"]).collect()] == [12]


def test_crowded_days_are_merged(spark, tmp_path):
    path, keys, order = str(tmp_path / "view"), ["kind"], ["ts", "n"]
    for i in range(12):
        rows = [(i, NOON + dt.timedelta(minutes=i), "ab"[i % 2]), (100 - i, NOON + dt.timedelta(days=1 + i % 3), "c")]
        batch = spark.createDataFrame(rows, "n long, ts timestamp, kind string").withColumn("event_date", F.to_date("ts"))
        upsert.write_batch(batch, "q", i, path, keys, order, "event_date", tasks=4)
    before = sorted(tuple(r) for r in upsert.current_rows(spark, path, keys, order).collect())
    table = Table(spark, path)
    state = table.state()
    assert len(state.dirs) == 24 and upsert.compact(spark, path, keys, order, most=4) == ["2024-05-01"]
    assert len(table.state().dirs) == 13 and table.read().count() == 14
    assert upsert.compact(spark, path, keys, order, most=1) == ["2024-05-02", "2024-05-03", "2024-05-04"]
    assert len(table.state().dirs) == 4 and upsert.compact(spark, path, keys, order, most=1) == []
    assert sorted(tuple(r) for r in upsert.current_rows(spark, path, keys, order).collect()) == before
    # A reader of the state before still finds its files; they go once no reader can need them.
    assert table.read(state).count() == 24 and table.tidy(older_than=3600) == []
    assert len(table.tidy(older_than=0)) == 24 and table.read().count() == 5
    # A batch that comes again after the merge is known by its number.
    assert not upsert.write_batch(batch, "q", 11, path, keys, order, "event_date")
    plan = upsert.current_rows(spark, path, keys, order).filter("event_date = '2024-05-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_a_merge_gives_way_to_another_commit(spark, tmp_path, monkeypatch):
    path, keys, order = str(tmp_path / "view"), ["kind"], ["ts", "n"]
    for i in range(3):
        batch = spark.createDataFrame([(i, NOON, "a")], "n long, ts timestamp, kind string").withColumn("event_date", F.to_date("ts"))
        upsert.write_batch(batch, "q", i, path, keys, order, "event_date", tasks=2)
    put = Table.put

    def interrupted(self, *args):
        written = put(self, *args)
        self.commit(lambda last: last.swap(last.dirs[:1], []))
        return written

    monkeypatch.setattr(Table, "put", interrupted)
    assert upsert.compact(spark, path, keys, order, most=1) == []
    assert len(Table(spark, path).state().dirs) == 2


def test_upsert_merges_while_it_runs(spark, tmp_path):
    src, view, cp = (str(tmp_path / n) for n in ("in", "view", "cp"))
    for first in range(0, 90, 10):
        stream = ticks(spark, src, [first, first + 1, first + 2], first=first)
    upsert.start_upsert(stream, view, cp, keys=["kind"], order=["ts", "n"], ts="ts", compact_every=3, most=2, availableNow=True).awaitTermination()
    table = Table(spark, view)
    assert table.state().done and max(table.state().done.values()) == 8 and len(table.state().dirs) == 1
    assert [r.n for r in upsert.current_rows(spark, view, ["kind"], ["ts", "n"]).collect()] == [82]


class Session:
    """As much of a session as the choice of a work folder looks at."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self
        self.master = master

    def getCheckpointDir(self):
        return None


def test_work_folder_comes_from_the_session():
    cluster = Session("spark://host:7077", "/shared/ckpt/")
    assert shared_folder(cluster).startswith("/shared/ckpt/run-")
    assert shared_folder(cluster) != shared_folder(cluster)
    with pytest.raises(ValueError):
        shared_folder(Session("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session("spark://host:7077"))


def test_unreadable_messages_keep_one_reason(spark):
    df = spark.createDataFrame([(["invalid_json"], ["missing_source"]), ([C.VIOLATION + "email", C.UNKNOWN_FIELDS], ["invalid_email"])], "v array<string>, r array<string>")
    got = [r[0] for r in df.select(jobs.merged_reasons(F.col("v"), F.col("r"))).collect()]
    assert got == [["invalid_json"], [C.UNKNOWN_FIELDS, "invalid_email"]]
    assert frame(spark, [{}]).count() == 1


@pytest.mark.parametrize("name", ["users_created", "people.v2"])
def test_job_checks_the_configured_topic(spark, tmp_path, name):
    options = JobOptions(salt="x", created_topic=name, reference_date=TODAY)
    write_log(spark, str(tmp_path / "log"), [message(0, {})])
    checked = jobs.validate_log(spark.read.parquet(str(tmp_path / "log")), options)
    assert checked.first().rejection_reasons == []


def test_a_running_job_moves_with_the_date(spark, tmp_path):
    tomorrow = (dt.datetime.now(tz=dt.UTC) + dt.timedelta(days=1)).isoformat(timespec="seconds")
    write_log(spark, str(tmp_path / "log"), [message(0, {"registered_at": tomorrow}), message(1, {})])
    log = spark.read.parquet(str(tmp_path / "log")).withColumn("headers", RT.correlation_headers(F.lit("r"), F.lit("t")))
    checked = jobs.validate_log(log, JobOptions(salt="x"))
    assert [r.rejection_reasons for r in checked.orderBy("offset").collect()] == [["registered_in_future"], []]
    assert "headers" in checked.columns


def test_routed_rows_carry_their_metadata(spark, tmp_path):
    write_log(spark, str(tmp_path / "log"), [message(0, {}), message(1, {"username": ""})])
    log = event_log.stream_files(spark, str(tmp_path / "log")).withColumn("headers", RT.correlation_headers(F.lit("r1"), F.lit("t1")))
    jobs.start_route(log, OPTIONS, str(tmp_path / "cp"), path=str(tmp_path / "out"), availableNow=True).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("timestamp").collect()
    assert [(r.validation_status, r.reason_count) for r in rows] == [("valid", 0), ("invalid", 1)]
    assert all(r.age_years > 13 and r.processed_at and r.headers[0].key == "request_id" for r in rows)


def test_exactly_once_spreads_its_files(spark, tmp_path, monkeypatch):
    from profilegate.plans import landed as L
    from profilegate.plans import queries as Q

    event = ["id AS event_id", "timestamp_micros(86400000000 + id * 4000000000) AS ts", "id % 7 AS user_id", "'view' AS event_type", "id / 4 AS value"]
    spark.range(0, 600, 1, 4).selectExpr(*event).repartition(4).write.parquet(str(tmp_path / "in/events.parquet"))
    base = f"file://{tmp_path}/work"
    monkeypatch.setattr(Q, "shared_folder", lambda _: base)
    out = Q.stream_exactly_once(spark, f"file://{tmp_path}/in")
    assert sorted(r["event_id"] for r in out.collect()) == list(range(600))
    files = spark.read.parquet(base + "/events").select(F.input_file_name()).distinct().count()
    batches = spark.read.text(base + "/checkpoint/sources/0/*").filter("value LIKE '{%'")
    batches = batches.select(F.get_json_object("value", "$.batchId").alias("b")).distinct().count()
    assert files > L.PARTS == batches


def test_exactly_once_deals_messages_by_their_number(spark, tmp_path, monkeypatch):
    """A part of the stream has as many files as its rows need, though the events lie in one small file."""
    from profilegate.plans import landed as L
    from profilegate.plans import queries as Q

    event = ["id AS event_id", "timestamp_micros(86400000000 + id * 4000000000) AS ts", "id % 7 AS user_id", "'view' AS event_type", "id / 4 AS value"]
    spark.range(0, 600, 1, 1).selectExpr(*event).write.parquet(str(tmp_path / "in/events.parquet"))
    base = f"file://{tmp_path}/work"
    monkeypatch.setattr(Q, "shared_folder", lambda _: base)
    monkeypatch.setattr(Q.FX, "ROWS_A_TASK", 20)
    out = Q.stream_exactly_once(spark, f"file://{tmp_path}/in")
    assert sorted(r["event_id"] for r in out.collect()) == list(range(600))
    files = spark.read.parquet(base + "/events").groupBy(F.input_file_name()).count().collect()
    assert len(files) > 5 * L.PARTS and max(r["count"] for r in files) < 40


def test_exactly_once_depends_on_its_state(spark, monkeypatch):
    """With a key no copy shares, the copies come out: it is the state that holds them back, not the watermark."""
    from profilegate.plans import queries as Q

    monkeypatch.setattr(Q.V2, "payload_hash", lambda json: F.sha2(json.cast("binary"), 256))
    out = Q.QUERIES["stream_exactly_once"](spark, "/root/testdata/sf0.001")
    copies = spark.read.parquet("/root/testdata/sf0.001/events.parquet").filter("event_id % 3 != 0").count()
    assert 1000 + 0.8 * copies < out.count() <= 1000 + copies


ALIKE = [
    ('{"b":1,"a":[1.0,2.50,{"z":1e2,"y":null}],"c":"1.0"}', '{"c":"1.0", "a":[1,2.5,{"y":null,"z":100.00}],"b":1.000}'),
    ('{"a":1e10}', '{"a":10000000000.0}'), ('{"a":-0.0}', '{"a":0}'), ('{"a":1.5e-3}', '{"a":0.00150}'),
    ('{"a":true,"a":false}', '{"a":false}'), ("[ ]", "[]"), ("1E2", "100"), (' "x" ', '"x"'),
    ('{"a":[{"b":[{"c":[{"d":{"y":1.0,"x":2}}]}]}]}', '{"a":[{"b":[{"c":[{"d":{"x":2,"y":1}}]}]}]}'),
    ('{"é\\"k":1}', '{"\\u00e9\\"k":1.0}'),
]
UNLIKE = ["{}", "[]", '{"a":1}', '{"a":"1"}', '{"a":[1]}', '{"a":null}', '{"a":{}}', "1", '"1"', "[1,2]", "[2,1]", "[[1],2]", "[1,[2]]", "not json", "null",
          '{"a":123456789012345678901234567890}', '{"a":123456789012345678901234567891}', '{"a":9007199254740993}', '{"a":9007199254740992}', "", '{"a:1":2}']


def test_payload_hash_tells_contents_not_spellings(spark):
    hashed = lambda texts: [r[0] for r in spark.createDataFrame([(t,) for t in texts], "j string").coalesce(1).select(variants.payload_hash(F.col("j"))).collect()]
    one, two = hashed([a for a, _ in ALIKE]), hashed([b for _, b in ALIKE])
    assert one == two and len(set(one)) == len(ALIKE)
    assert len(set(hashed(UNLIKE))) == len(UNLIKE) and hashed([None]) == [None]
    text = spark.createDataFrame([(ALIKE[0][0],)], "j string").select(variants.canonical(F.try_parse_json("j"))).first()[0]
    assert text == '{"a":[1,2.5,{"y":null,"z":100}],"b":1,"c":"1.0"}'


def crashing(*steps):
    left = set(steps)

    def crash(step, batch_id):
        if (step, batch_id) in left:
            left.remove((step, batch_id))
            raise RuntimeError(f"crash: {step} {batch_id}")

    return crash


def test_a_batch_comes_out_once_whatever_crashes(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for first in range(0, 40, 10):
        stream = ticks(spark, src, [first, first + 1], first=first)
    crash = crashing(("written", 0), ("committed", 1), ("written", 2), ("committed", 2), ("committed", 3))
    starts = 0
    while True:
        starts += 1
        query = sink.start_table(stream, out, cp, partition_by=["kind"], on_step=crash, availableNow=True)
        try:
            query.awaitTermination()
            break
        except StreamingQueryException:
            pass
    assert starts == 6
    assert sorted(r.n for r in Table(spark, out).read().collect()) == [0, 1, 10, 11, 20, 21, 30, 31]
    # What the crashes left behind is not read, and goes.
    assert len(Table(spark, out).tidy(0)) == 2
    # Another query on the same table is told apart.
    sink.start_table(stream, out, cp + "2", partition_by=["kind"], availableNow=True).awaitTermination()
    assert Table(spark, out).read().count() == 16


def test_without_its_record_a_batch_would_double(spark, tmp_path, monkeypatch):
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    stream = ticks(spark, src, [0, 1])
    monkeypatch.setattr(Table, "has_batch", lambda *_: False)
    commit = Table.commit_batch
    monkeypatch.setattr(Table, "commit_batch", lambda self, q, b, dirs, empty, mark=None: commit(self, f"{q}{len(dirs[0])}{dirs[0]}", b, dirs, empty, mark))
    with pytest.raises(StreamingQueryException):
        sink.start_table(stream, out, cp, on_step=crashing(("committed", 0)), availableNow=True).awaitTermination()
    sink.start_table(stream, out, cp, availableNow=True).awaitTermination()
    assert Table(spark, out).read().count() == 4


def test_late_rows_are_those_spark_would_drop(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("in", "split", "cp"))
    minutes = [[0, 5, 59], [48, 49, 50, 70], [60, 61], [], [59, 60, 200], [189, 190, 191, 10]]
    for i, batch in enumerate(minutes):
        if batch:
            stream = ticks(spark, src, batch, first=10 * i)
        late.start_split(stream, out, cp, ts="ts", delay=dt.timedelta(minutes=10), availableNow=True).awaitTermination()
    rows = late.read_split(spark, out)
    got = {(r.batch_id, r.side): r.n for r in rows.groupBy("batch_id", "side").agg(F.sort_array(F.collect_list("n")).alias("n")).collect()}
    assert got == {
        (0, "on_time"): [0, 1, 2], (1, "late"): [10, 11], (1, "on_time"): [12, 13], (2, "late"): [20], (2, "on_time"): [21],
        (3, "late"): [40, 41], (3, "on_time"): [42], (4, "late"): [50, 51, 53], (4, "on_time"): [52],
    }
    late_rows = sum(len(n) for (_, side), n in got.items() if side == "late")
    assert rows.count() == sum(map(len, minutes))
    # What Spark's own operators drop over the same batches; where several may be stateful, they wait one batch longer.
    dropped = {}
    for several in ("false", "true"):
        spark.conf.set("spark.sql.streaming.statefulOperator.allowMultiple", several)
        totals = jobs.watch(spark)
        try:
            counted = stream.withWatermark("ts", "10 minutes").dropDuplicatesWithinWatermark(["n"])
            query = counted.writeStream.format("noop").option("checkpointLocation", cp + several).trigger(availableNow=True).start()
            query.awaitTermination()
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
            dropped[several] = totals.of(query)["late_rows"]
        finally:
            spark.conf.unset("spark.sql.streaming.statefulOperator.allowMultiple")
            spark.streams.removeListener(totals)
    assert dropped["false"] == late_rows and 0 < dropped["true"] < late_rows


def test_late_rows_of_a_batch_that_runs_again(spark, tmp_path):
    path = str(tmp_path / "split")
    rows = lambda *at: spark.createDataFrame([(i, None if m is None else NOON + dt.timedelta(minutes=m)) for i, m in enumerate(at)], "n long, ts timestamp")
    delay = dt.timedelta(minutes=10)
    assert late.split_batch(rows(0, 100), "q", 0, path, "ts", delay)
    assert late.split_batch(rows(1, None, 95), "q", 1, path, "ts", delay)
    assert not late.split_batch(rows(1, None, 95), "q", 1, path, "ts", delay)
    assert late.split_batch(rows(1), "other", 0, path, "ts", delay)
    assert late.split_batch(rows(), "q", 2, path, "ts", delay)
    got = sorted((r.batch_id, r.side, r.n) for r in late.read_split(spark, path).collect())
    assert got == [(0, "on_time", 0), (0, "on_time", 0), (0, "on_time", 1), (1, "late", 0), (1, "on_time", 1), (1, "on_time", 2)]
    assert Table(spark, path).state().marks["q"] == int((NOON + dt.timedelta(minutes=100)).timestamp() * 1000)
    plan = late.read_split(spark, path).filter("side = 'late'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(side" in plan


def test_progress_of_more_batches_than_a_query_remembers(spark, tmp_path):
    src, cp, path = (str(tmp_path / n) for n in ("in", "cp", "progress"))
    schema = "n long"
    log = progress.log_progress(spark, path)
    try:
        for part in (70, 50):
            spark.range(0, part, 1, part).selectExpr("id AS n").write.mode("append").parquet(src)
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src).observe("o", F.count(F.lit(1)).alias("rows"))
            query = stream.writeStream.format("noop").option("checkpointLocation", cp).trigger(availableNow=True).start()
            query.awaitTermination()
            log.wait(query)
            again = stream.writeStream.format("noop").option("checkpointLocation", cp).trigger(availableNow=True).start()
            again.awaitTermination()  # a start without news
    finally:
        spark.streams.removeListener(log)
    rows = progress.read_progress(spark, path)
    files = rows.groupBy("query_id").agg(F.count("*").alias("n"), F.countDistinct("batch_id").alias("d"), F.countDistinct("run_id").alias("runs")).first()
    assert files.n == files.d >= 100 and files.runs >= 2
    total = progress.totals(rows).first()
    assert total.input_rows == 120 == total.observed["o.rows"]


def attempt(request, number, minute, reason=None, retryable=False):
    return (request, number, NOON + dt.timedelta(minutes=minute), reason, retryable)


ATTEMPTS = "request_id string, attempt int, requested_at timestamp, reason string, retryable boolean"


def test_attempts_are_resolved_as_they_settle(spark, tmp_path):
    batches = [
        [attempt("ok", 0, 0), attempt("late", 1, 0), attempt("retry", 0, 0, "timeout", True), attempt("lost", 0, 1, "timeout", True), attempt("none", None, 1)],
        [attempt("ok", 0, 2), attempt("late", 0, 2, "http_503", True), attempt("retry", 1, 2, "timeout", True), attempt("beyond", 7, 2)],
        [attempt("retry", 2, 4, "http_404"), attempt("ok", 1, 4, "http_404"), attempt("order", 2, 4, "http_404"), attempt("order", 0, 4, "timeout", True)],
        [attempt("last", n, 6, "timeout", True) for n in range(3)] + [attempt("order", 1, 6)],
        [attempt("clock", 0, 60)],
        [attempt("clock2", 0, 90)],
    ]
    src, seen, base = str(tmp_path / "in"), set(), tmp_path
    found = []
    for rows in batches:
        spark.createDataFrame(rows, ATTEMPTS).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(ATTEMPTS).option("maxFilesPerTrigger", 1).parquet(src)
        _, out = run(spark, attempts.resolve_stream(stream, 2), base, "resolved")
        now = {tuple(r) for r in out.collect()}
        found.append(sorted(now - seen))
        seen = now
    assert found[0] == [("ok", "ok", 1, "success")]
    assert found[1] == [("late", "ok", 2, "success")]
    assert found[2] == [("retry", "http_404", 3, "final_failure")]
    assert found[3] == [("last", "timeout", 3, "last_retry"), ("order", "ok", 2, "success")]
    timed_out = sorted(r for rows in found[4:] for r in rows if r[3] == "timeout")
    assert timed_out == [("beyond", "no_attempt", 0, "timeout"), ("lost", "timeout", 1, "timeout"), ("none", "no_attempt", 0, "timeout")]
    assert len(seen) == sum(map(len, found)) == len({r[0] for r in seen})
    with pytest.raises(ValueError):
        attempts.resolve_stream(stream, -1)


def test_attempts_are_resolved_by_the_bucket(spark, tmp_path):
    rows = [[attempt(None if i == 7 else f"r{i}", n, i * 0.01, "timeout" if (i + n) % 3 else None, bool((i + n) % 3)) for i in range(200)] for n in (1, 0, 2)]
    for part in rows:
        spark.createDataFrame(part, ATTEMPTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(ATTEMPTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query, out = run(spark, attempts.resolve_stream(stream, 2, timeout="1 day", buckets=5), tmp_path, "resolved")
    whole = normalize.resolve_attempts(spark.createDataFrame(sum(rows, []), ATTEMPTS), 2)
    assert sorted(map(repr, out.select("request_id", "outcome", "attempts_made").collect())) == sorted(map(repr, whole.collect()))
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) == 5


def test_replay_takes_the_place_of_what_was_there(spark, tmp_path):
    log, view = str(tmp_path / "log"), str(tmp_path / "view")
    at = lambda minute: NOON + dt.timedelta(minutes=minute)
    rows = [(b"k", b"v", "t", 0, i, at(17 * i)) for i in range(40)]
    event_log.land_by_hour(spark.createDataFrame(rows, S.EVENT_LOG_SCHEMA), log, "a")
    process = lambda tag: lambda df: df.select("offset", "hour", F.lit(tag).alias("tag"))
    offsets = lambda: sorted((r.offset, r.tag) for r in V.read_view(spark, view).collect())
    event_log.replay(spark, log, view, at(0), at(17 * 40), process("first"))
    assert offsets() == [(i, "first") for i in range(40)]
    for _ in range(2):
        hours = event_log.replay(spark, log, view, at(90), at(200), process("again"))
        assert hours == ["2024-05-01T13", "2024-05-01T14", "2024-05-01T15"]
        assert offsets() == [(i, "again" if 60 <= 17 * i < 240 else "first") for i in range(40)]
    # Late records of an hour come with a load of their own, and with the next replay of that hour.
    event_log.land_by_hour(spark.createDataFrame([(b"k", b"v", "t", 0, 99, at(100))], S.EVENT_LOG_SCHEMA), log, "b")
    event_log.replay(spark, log, view, at(100), at(101), process("late"))
    assert [(o, t) for o, t in offsets() if t == "late"] == [(i, "late") for i in range(4, 8) if 60 <= 17 * i < 120] + [(99, "late")]
    assert event_log.replay(spark, log, view, at(5), at(5), process("none")) == [] and len(offsets()) == 41
    plan = event_log.read_hours(spark, log, hours)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hour" in plan
    with pytest.raises(ValueError):
        event_log.hours_between(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))


def test_settled_text_is_what_taking_it_apart_gives(spark):
    """Text that is taken as it is must equal what comes of its members, and ordinary messages are taken as they are."""
    odd = ['{"a\\n\\u0001\\"/é":"\\t\\u2028\\\\"}', '{"😀":1,"\ufffd":2,"a":3}', '{"a":-0.0,"b":-0,"c":0e0}', '{"a":"1E2","b":"2.50"}', '{"a":1e400}', '{"a":2.0E-3}',
           '{"b":{"b":{"b":{"b":{"b":{"b":{"b":{"z":1.50,"y":[1e2,2]}}}}}}}}', '{"a":1234567.0e1,"b":12345678.25}', '{"a":0.1,"b":100,"c":1.05,"d":-10}', '{"":[[],{}]}']
    texts = [t for pair in ALIKE for t in pair] + UNLIKE + odd
    parsed = spark.createDataFrame([(t,) for t in texts], "j string").select("j", F.try_parse_json("j").alias("v"))
    rows = parsed.select("j", variants.canonical(F.col("v")).alias("one"), variants._settled(F.col("v"), 6).alias("two")).collect()
    assert [(r.j, r.one) for r in rows] == [(r.j, r.two) for r in rows]
    assert {r.j: r.one for r in rows}["not json"] is None
    event = '{"event":%d,"user":{"id":7,"kind":"view"},"value":%s,"tags":[1.0,null]}'
    common = spark.createDataFrame([(event % (i, f"{i}{j}e-2"),) for i in range(1, 10) for j in (25, 10, 99)], "j string")
    assert common.filter(F.to_json(F.try_parse_json("j")).rlike(variants._UNSETTLED)).count() == 0

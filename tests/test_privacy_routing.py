import hashlib
import hmac
import json

import pytest
from people import GOOD, TODAY, frame
from pyspark.sql import functions as F

from profilegate import schemas as S
from profilegate.functions.privacy import hmac_sha256, pseudonym
from profilegate.operators import contract as C
from profilegate.operators import rejects
from profilegate.operators import routing as RT
from profilegate.options import KAFKA_SINK_SETTINGS, JobOptions

OPTIONS = JobOptions(salt="pepper", created_schema_id=258, invalid_schema_id=7)


def expected(salt, source, user):
    return "sha256:" + hmac.new(salt.encode(), f"{source}:{user}".encode(), hashlib.sha256).hexdigest()


@pytest.mark.parametrize("salt", ["s", "é" * 10, "x" * 64, "y" * 65, "z" * 200])
def test_hmac_equals_the_library(spark, salt):
    words = ["", "a", "crm:1", "naïve ☃", "x" * 300]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r.w: r.h for r in df.select("w", hmac_sha256(F.col("w"), salt).alias("h")).collect()}
    assert got == {w: hmac.new(salt.encode(), w.encode(), hashlib.sha256).hexdigest() for w in words}


def test_pseudonyms_need_a_salt_and_an_id(spark):
    for salt in (None, ""):
        with pytest.raises(ValueError, match="salt"):
            pseudonym(F.col("a"), F.col("b"), salt)
    df = spark.createDataFrame([("crm", None), ("crm", ""), (None, "7")], "s string, i string")
    got = [r[0] for r in df.select(pseudonym(F.col("s"), F.col("i"), "x")).collect()]
    assert got == [None, None, expected("x", "", "7")]


def test_invalid_events_carry_nothing_personal(spark):
    people = frame(spark, [{}, {"username": ""}, {"country_code": None, "country": "Ruritania", "street_name": "\x01"}])
    events = rejects.invalid_events(C.check_profiles(people, TODAY), "pepper")
    assert events.dtypes == [(f.name, f.dataType.simpleString()) for f in S.USER_PROFILE_INVALID_SCHEMA]
    assert events.schema["rejection_reasons"].dataType.containsNull is False
    rows = events.collect()
    assert len(rows) == 2
    personal = [v for n, v in GOOD.items() if n not in ("source", "country_code", "nationality", "street_number", "title")]
    for row in rows:
        text = json.dumps(row.asDict(recursive=True))
        assert row.source_user_id == expected("pepper", "random_user", "id-0001")
        assert row.payload.event_type == "UserCreated" and "pepper" not in text
        assert not [v for v in personal if str(v) in text]
    assert rows[1].payload.country_code is None


def test_every_row_is_routed_once_and_reads_back(spark):
    people = frame(spark, [{}, {"username": ""}, {"source_user_id": None}, {"registered_at": "2023-03-04T05:06:07.120000Z"}])
    checked = C.check_profiles(people, TODAY)
    back = RT.unframe(RT.route(checked, OPTIONS, "case")).orderBy("case").collect()
    assert [r.topic for r in back] == [S.VALID_TOPIC, S.INVALID_TOPIC, S.INVALID_TOPIC, S.VALID_TOPIC]
    assert [r.schema_id for r in back] == [258, 7, 7, 258]
    assert bytes(back[0].value)[:5] == b"\x00\x00\x00\x01\x02"
    assert [r.key and bytes(r.key).decode() for r in back[:3]] == ["id-0001", expected("pepper", "random_user", "id-0001"), None]
    event = json.loads(back[0].json)
    assert list(event) == list(S.PROFILE_FIELDS)
    assert event == GOOD | {
        "schema_version": "1.0", "event_type": "UserCreated", "latitude": 53.3331, "longitude": -6.2489,
        "date_of_birth": "1980-06-23T00:00:00Z", "registered_at": "2023-03-04T05:06:07Z",
    }
    assert json.loads(back[3].json)["registered_at"] == "2023-03-04T05:06:07.120000Z"
    reject = json.loads(back[2].json)
    assert reject["source_user_id"] is None and reject["rejection_reasons"] == ["missing_source_user_id"]


def test_unframe_refuses_other_bytes(spark):
    values = [b"\x00\x00\x00\x00\x05{}", b"\x01\x00\x00\x00\x05{}", b"{}", b"", None, b"\x00\x00\x00\x00", b"\x00\xff\xff\xff\xff", b"\x00\x00\x00\x00\x01\xff\xfe"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value binary")
    got = [(r.schema_id, r.json) for r in RT.unframe(df).orderBy("i").collect()]
    assert got == [(5, "{}"), (None, None), (None, None), (None, None), (None, None), (None, None), (4294967295, ""), (1, None)]


def test_headers_leave_out_unknown_ids(spark):
    df = spark.createDataFrame([("r", None)], "a string, b string")
    headers = df.select(RT.correlation_headers(F.col("a"), F.col("b"))).first()[0]
    assert [(h.key, bytes(h.value)) for h in headers] == [("request_id", b"r")]


def test_kafka_options():
    plain = JobOptions(bootstrap_servers=("a:1", "b:2"), app_name="job").kafka_sink()
    assert plain == {"kafka.bootstrap.servers": "a:1,b:2", "kafka.client.id": "job"} | KAFKA_SINK_SETTINGS
    secure = JobOptions(sasl_username="u", sasl_password='p"w').kafka_sink()
    assert secure["kafka.security.protocol"] == "SASL_SSL" and secure["kafka.sasl.mechanism"] == "PLAIN"
    assert r'password="p\"w"' in secure["kafka.sasl.jaas.config"]
    source = JobOptions(max_offsets_per_trigger=10).kafka_source()
    assert (source["subscribe"], source["startingOffsets"], source["maxOffsetsPerTrigger"]) == (S.CREATED_TOPIC, "earliest", "10")
    assert source["includeHeaders"] == "true"


def test_no_topic_is_read_and_written():
    options = JobOptions(salt="s")
    assert not {options.valid_topic, options.invalid_topic} & set(options.kafka_source()["subscribe"].split(","))
    for topic in (options.valid_topic, options.invalid_topic):
        with pytest.raises(ValueError):
            options.kafka_source((options.created_topic, topic))
        with pytest.raises(ValueError):
            JobOptions(created_topic=topic)


def test_options_are_checked():
    with pytest.raises(ValueError, match="salt"):
        JobOptions(environment="production")
    assert JobOptions(environment="production", salt="x").salt == "x"
    with pytest.raises(ValueError, match="salt"):
        JobOptions(environment="production", salt="")
    for wrong in (dict(sasl_username="u"), dict(bootstrap_servers=()), dict(bootstrap_servers=(" ",)), dict(invalid_topic=S.CREATED_TOPIC)):
        with pytest.raises(ValueError):
            JobOptions(**wrong)
    assert "hush" not in repr(JobOptions(salt="hush", sasl_username="u", sasl_password="hush"))


def test_route_reads_its_input_once(spark):
    checked = C.check_profiles(frame(spark, [{}]), TODAY)
    plan = RT.route(checked, OPTIONS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") == 1 and "Exchange" not in plan

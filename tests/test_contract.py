import json

import pytest
from people import GOOD, TODAY, frame, reasons
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilegate import schemas as S
from profilegate.operators import contract as C
from profilegate.operators import rejects
from profilegate.operators import routing as RT
from profilegate.options import JobOptions

# By rule: changes to a good profile that break it, and the reason each of them gives.
BROKEN = {
    "contract_violation:schema_version": [{"schema_version": "v1"}],
    "contract_violation:event_type": [{"event_type": "userCreated"}],
    "contract_violation:first_name": [{"first_name": ""}, {"first_name": None}, {"first_name": "\u2003"}],
    "contract_violation:last_name": [{"last_name": "\t"}],
    "missing_source": [{"source": "\u00a0"}],
    "missing_source_user_id": [{"source_user_id": "\n"}],
    "missing_username": [{"username": None}],
    "missing_email": [{"email": "   "}],
    "missing_country": [{"country": None}],
    "missing_date_of_birth": [{"date_of_birth": " "}],
    "invalid_email": [
        {"email": x}
        for x in ("grace", "@hopper.net", "grace@", "gr..ace@hopper.net", "grace@hopper", "g@hopper.77", "g race@hopper.net", "q" * 65 + "@hopper.net")
    ],
    "invalid_country_code": [{"country_code": "IRLX"}, {"country_code": "Q1"}],
    "invalid_date_of_birth": [{"date_of_birth": "1985-13-40"}, {"date_of_birth": "last spring"}],
    "invalid_registered_at": [{"registered_at": "2019/03/04"}, {"registered_at": "25:61"}],
    "invalid_latitude": [{"latitude": "-90.5"}, {"latitude": "0x1F"}],
    "invalid_longitude": [{"longitude": "-180.01"}, {"longitude": "12,5"}],
    "invalid_picture_url:picture_large": [{"picture_large": "pictures/7.png"}, {"picture_large": "https:pic.hopper.net"}],
}
FINE = [{}, {"email": "q" * 64 + "@hopper.net"}, {"email": "søren@hopper.net"}, {"schema_version": None}, {"latitude": "-90"}, {"longitude": "+1.8e2"}]
MODEL_CASES = [(case, []) for case in FINE] + [(case, [code]) for code, cases in BROKEN.items() for case in cases]


def test_structural_reasons(spark):
    got = reasons(C.check_profiles(frame(spark, [c for c, _ in MODEL_CASES]), TODAY))
    wrong = [(c, want, have) for (c, want), have in zip(MODEL_CASES, got, strict=True) if want != have]
    assert wrong == []


def test_checked_profiles_have_the_event_types(spark):
    checked = C.check_profiles(frame(spark, [{"source": " random_user\t", "email": " Alan@EXAMPLE.org "}]), TODAY)
    event = rejects.valid_events(checked)
    assert [(f.name, f.dataType) for f in event.schema] == [(f.name, f.dataType) for f in S.USER_CREATED_SCHEMA]
    row = event.first()
    assert (row.source, row.email, row.latitude) == ("random_user", "Alan@example.org", 53.3331)
    assert row.date_of_birth.year == 1980 and row.schema_version == "1.0" and row.event_type == "UserCreated"


def wire(**change):
    event = {"schema_version": "1.0", "event_type": "UserCreated"} | GOOD | {"latitude": 53.3, "longitude": -6.2}
    event |= change
    return json.dumps({k: v for k, v in event.items() if v is not ...})


V = C.VIOLATION
WIRE_CASES = [
    (wire(), []),
    (wire(gender=None, street_number=None, latitude=None), []),
    (wire(gender=...), []),
    (wire(extra=1), [V + "additional_properties"]),
    (wire(schema_version=...), [V + "schema_version"]),
    (wire(schema_version=1.0), [V + "schema_version"]),
    (wire(email=...), [V + "email"]),
    (wire(source=""), [V + "source"]),
    (wire(username=None), [V + "username"]),
    (wire(gender=1), [V + "gender"]),
    (wire(street_number=42.0), []),
    (wire(street_number=42.5), [V + "street_number"]),
    (wire(street_number="42"), [V + "street_number"]),
    (wire(street_number=True), [V + "street_number"]),
    (wire(country_code="IRL"), [V + "country_code"]),
    (wire(latitude=-90), []),
    (wire(latitude=90.001), [V + "latitude"]),
    (wire(latitude="53.3"), [V + "latitude"]),
    (wire(date_of_birth="1980"), [V + "date_of_birth"]),
    (wire(registered_at=5), [V + "registered_at"]),
    (wire(picture_large="x"), [V + "picture_large"]),
    (wire(source="", latitude="x"), [V + "source", V + "latitude"]),
    ("{", [C.INVALID_JSON]),
    ("", [C.INVALID_JSON]),
    ("5", [C.INVALID_JSON]),
    (None, [C.INVALID_JSON]),
    ("[" + wire() + "]", [C.INVALID_JSON]),
    (wire() + " x", [C.INVALID_JSON]),
    (wire() + "," + wire(), [C.INVALID_JSON]),
    *[(wire() + tail, [C.INVALID_JSON]) for tail in ("],[{}", '],"x"', "] more", "]", ',"x"', "],[")],
    (" " + wire() + "\n", []),
    (wire(street_number=2**53 + 1), []),
    (wire(street_number=2**63 - 1), []),
    (wire(street_number=2**63), [V + "street_number"]),
    (wire(street_number=10**40), [V + "street_number"]),
]


def test_integers_keep_their_value(spark):
    numbers = [2**53 + 1, -(2**63), 42.0, 7e2, 0, 42.5, 2**63]
    rows = spark.createDataFrame([(i, S.CREATED_TOPIC, wire(street_number=n)) for i, n in enumerate(numbers)], "i int, topic string, value string")
    read = C.read_created(C.check_messages(rows, keep_parsed="p"), "p").orderBy("i").collect()
    assert [r.street_number for r in read] == [2**53 + 1, -(2**63), 42, 700, 0, None, None]


def check(spark, values, topic=S.CREATED_TOPIC, **kw):
    rows = spark.createDataFrame([(i, topic, v) for i, v in enumerate(values)], "case int, topic string, value string")
    return [r.violations for r in C.check_messages(rows, **kw).orderBy("case").collect()]


def test_created_messages_against_their_contract(spark):
    got = check(spark, [v for v, _ in WIRE_CASES])
    wrong = [(v and v[:80], want, have) for (v, want), have in zip(WIRE_CASES, got, strict=True) if want != have]
    assert wrong == []


def invalid(**change):
    event = {
        "schema_version": "1.0", "event_type": "UserProfileInvalid", "source": "crm",
        "source_user_id": "sha256:" + "a" * 64, "rejection_reasons": ["missing_email"], "payload": {},
    }
    event |= change
    return json.dumps({k: v for k, v in event.items() if v is not ...})


def test_invalid_messages_against_their_contract(spark):
    cases = [
        (invalid(), []),
        (invalid(payload=..., source=None, source_user_id=None), []),
        (invalid(rejection_reasons=[]), [V + "rejection_reasons"]),
        (invalid(rejection_reasons=[""]), [V + "rejection_reasons"]),
        (invalid(rejection_reasons=["a", 1]), [V + "rejection_reasons"]),
        (invalid(rejection_reasons=...), [V + "rejection_reasons"]),
        (invalid(source_user_id="id-1"), [V + "source_user_id"]),
        (invalid(source_user_id="sha256:" + "A" * 64), [V + "source_user_id"]),
        (invalid(source_user_id="sha256:" + "a" * 64 + "\n"), [V + "source_user_id"]),
        (invalid(payload=None), [V + "payload"]),
        (invalid(payload=[]), [V + "payload"]),
        (invalid(event_type="UserCreated", extra=1), [V + "additional_properties", V + "event_type"]),
    ]
    got = check(spark, [v for v, _ in cases], S.INVALID_TOPIC)
    assert [(v, h) for (v, w), h in zip(cases, got, strict=True) if w != h] == []


def test_topics_choose_contracts(spark):
    assert check(spark, [wire()], "elsewhere") == [[C.NO_CONTRACT]]
    assert check(spark, [wire()], None) == [[C.NO_CONTRACT]]
    renamed = C.contracts("people.v2", "people.bad")
    assert check(spark, [wire()], "people.v2", topic_contracts=renamed) == [[]]
    assert check(spark, [wire()], S.CREATED_TOPIC, topic_contracts=renamed) == [[C.NO_CONTRACT]]


def test_registered_contracts():
    created, rejected = C.registered_contracts("people.v2", "people.bad")
    assert (created["subject"], rejected["subject"]) == ("people.v2-value", "people.bad-value")
    assert {c["compatibility"] for c in (created, rejected)} == {"BACKWARD"}
    assert set(created["schema"]["properties"]) == {f.name for f in S.USER_CREATED_SCHEMA}
    assert created["schema"]["additionalProperties"] is False
    assert len(created["schema"]["required"]) == 10
    assert created["schema"]["properties"]["latitude"] == {"type": ["number", "null"], "minimum": -90.0, "maximum": 90.0}
    assert created["schema"]["properties"]["date_of_birth"] == {"type": "string", "format": "date-time"}
    assert set(rejected["schema"]["required"]) == {"schema_version", "event_type", "rejection_reasons"}
    assert rejected["schema"]["properties"]["payload"] == {"type": "object"}


def test_routed_records_conform_to_their_contracts(spark):
    people = frame(spark, [c for c, _ in MODEL_CASES])
    routed = RT.unframe(RT.route(C.check_profiles(people, TODAY), JobOptions(salt="s"))).drop("value")
    checked = C.check_messages(routed, value="json", topic_contracts=C.contracts(valid_topic=S.VALID_TOPIC))
    assert {tuple(r.violations) for r in checked.collect()} == {()}
    assert {r.topic for r in checked.select("topic").distinct().collect()} == {S.VALID_TOPIC, S.INVALID_TOPIC}


def test_repeated_keys_keep_the_last_value(spark):
    twice = wire()[:-1] + ', "gender": 5}'
    assert check(spark, [twice]) == [[V + "gender"]]


@pytest.mark.parametrize("bad", ["", ".", "..", "a/b", "x" * 250])
def test_topic_names_are_checked(bad):
    with pytest.raises(ValueError):
        JobOptions(created_topic=bad)


def test_types_survive_a_table_without_optional_columns(spark):
    narrow = spark.createDataFrame([("crm", "1")], "source string, source_user_id string")
    row = C.check_profiles(narrow, TODAY).first()
    assert row.rejection_reasons[:3] == ["contract_violation:first_name", "contract_violation:last_name", "missing_email"]
    assert isinstance(C.check_profiles(narrow, TODAY).schema["latitude"].dataType, T.DoubleType)
    assert C.check_profiles(narrow, TODAY).filter(F.col("latitude").isNotNull()).count() == 0

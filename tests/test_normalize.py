import json

import pytest
from people import GOOD, ITEM, REMOVED, body, item, response, responses

from profilegate import schemas as S
from profilegate.operators import normalize as N

BAD = "invalid_payload"
NULLS = {
    "location.street": ("street_number", "street_name"),
    "location.coordinates": ("latitude", "longitude"),
    "location.timezone": ("timezone_offset", "timezone_description"),
    "registered": ("registered_at",),
    "picture": S.PICTURE_FIELDS,
}
ITEM_CASES = (
    [(path, REMOVED, field) for path, field in (
        ("email", "email"), ("login.uuid", "source_user_id"), ("login.username", "username"), ("name.first", "first_name"),
        ("name.last", "last_name"), ("location.country", "country"), ("dob.date", "date_of_birth"), ("login", "login"),
        ("name", "name"), ("location", "location"), ("dob", "dob"))]
    + [(path, "text", path.split(".")[-1]) for path in NULLS]
    + [(path, value, None) for path in NULLS for value in (REMOVED, None)]
    + [
        ("location.postcode", 48.5, "postcode"), ("location.postcode", 1.0, "postcode"), ("location.postcode", {"a": 1}, "postcode"),
        ("location.postcode", True, "postcode"), ("location.postcode", 12345, None), ("location.postcode", 10**25, None),
        ("location.street.number", "7", "street_number"), ("location.street.number", 7.5, "street_number"),
        ("location.street.number", True, "street_number"), ("location.street.number", None, None),
        ("gender", 1, "gender"), ("gender", None, None), ("email", "", "email"), ("email", 5, "email"), ("login", [], "login"),
        ("login.uuid", None, "source_user_id"), ("phone", ["x"], "phone"), ("dob", None, "dob"),
    ]
)


def test_good_item_maps_to_the_flat_profile(spark):
    done = N.classify_responses(responses(spark, [response(0, body(ITEM))]))
    row = N.explode_profiles(done, "request_id").first().asDict()
    assert {n: row[n] for n in S.NORMALIZED_FIELDS} == GOOD
    assert (row["request_id"], row["position"]) == ("r000", 0)


def test_item_faults(spark):
    rows = [response(i, body(item(path, value))) for i, (path, value, _) in enumerate(ITEM_CASES)]
    done = N.classify_responses(responses(spark, rows)).orderBy("request_id").collect()
    for (path, value, field), row in zip(ITEM_CASES, done, strict=True):
        assert row.profiles[0].error_field == field, (path, value)
        assert row.reason == (BAD if field else None)
        if field is None and path in NULLS:
            assert all(row.profiles[0][n] is None for n in NULLS[path])


def test_postcodes_keep_their_digits(spark):
    rows = [response(0, body(item("location.postcode", 10**25))), response(1, body(item("location.postcode", 7)))]
    done = N.classify_responses(responses(spark, rows)).orderBy("request_id").collect()
    assert [r.profiles[0].postcode for r in done] == [str(10**25), "7"]


def test_response_reasons(spark):
    good = body(ITEM)
    cases = [
        (dict(body=good), None),
        (dict(body=None, error="timeout", status=None), "timeout"),
        (dict(body=None, error="connect", status=None), "http_error"),
        (dict(body=good, status=429), "http_429"),
        (dict(body=good, status=501), "http_501"),
        (dict(body=good, status=400), "http_400"),
        (dict(body=good, status=204), None),
        (dict(body=good, status=302), "http_302"),
        (dict(body="{"), "invalid_json"),
        (dict(body=""), "invalid_json"),
        (dict(body=None), "invalid_json"),
        (dict(body=good + "}"), "invalid_json"),
        (dict(body="[1]"), "unexpected_response"),
        (dict(body='{"info":1}'), "unexpected_response"),
        (dict(body='{"results":{}}'), "unexpected_response"),
        (dict(body='{"results":null}'), "unexpected_response"),
        (dict(body='{"results":[]}'), "empty_results"),
        (dict(body='{"results":["x"]}'), BAD),
        (dict(body='{"results":[null]}'), BAD),
        (dict(body=good, expected=2), "unexpected_response"),
        (dict(body=body(ITEM, ITEM), expected=2), None),
        (dict(body=body(ITEM, item("email")), expected=2), BAD),
        (dict(body=body(ITEM, item("email")), expected=3), BAD),
    ]
    rows = [response(i, **kw) for i, (kw, _) in enumerate(cases)]
    done = N.classify_responses(responses(spark, rows)).orderBy("request_id").collect()
    assert [(kw, r.reason) for (kw, want), r in zip(cases, done, strict=True) if r.reason != want] == []
    retryable = {r.reason for r in done if r.retryable}
    assert retryable == {"timeout", "http_error", "http_429", "http_501", "empty_results"}


def test_one_bad_item_drops_the_whole_response(spark):
    rows = [response(0, body(ITEM, item("email")), expected=2), response(1, body(ITEM, ITEM), expected=2)]
    done = N.classify_responses(responses(spark, rows))
    assert [(r.request_id, r.position) for r in N.explode_profiles(done, "request_id").orderBy("position").collect()] == [("r001", 0), ("r001", 1)]
    assert [r.error_field for r in N.first_error(done).collect()] == ["email"]


def test_attempts(spark):
    good, busy = body(ITEM), dict(body=None, status=503)
    plans = [
        ([busy, dict(body=good)], ("ok", 2)),
        ([busy, busy, busy], ("http_503", 3)),
        ([dict(body=None, status=400), dict(body=good)], ("http_400", 1)),
        ([dict(body=good), busy], ("ok", 1)),
        ([dict(body='{"results":[]}'), dict(body=body(item("email")))], (BAD, 2)),
        ([busy, busy, busy, dict(body=good)], ("http_503", 3)),
    ]
    rows = [response(i, attempt=a, **kw) for i, (tries, _) in enumerate(plans) for a, kw in enumerate(tries)]
    done = N.resolve_attempts(N.classify_responses(responses(spark, rows)), 2).orderBy("request_id").collect()
    assert [(r.outcome, r.attempts_made) for r in done] == [want for _, want in plans]
    with pytest.raises(ValueError):
        N.resolve_attempts(N.classify_responses(responses(spark, rows)), -1)


def test_repeated_json_keys_keep_the_last_value(spark):
    text = json.dumps({"results": [ITEM]}).replace('"nat": "IE"', '"nat": "IE", "nat": "FR"')
    assert N.classify_responses(responses(spark, [response(0, text)])).first().profiles[0].nationality == "FR"

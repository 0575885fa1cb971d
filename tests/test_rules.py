import datetime as dt

import pytest
from people import TODAY, frame, reasons
from pyspark.sql import functions as F

from profilegate.functions import text as X
from profilegate.operators import rules as R

LONG_URL = "https://example.org/" + "x" * 2048

CASES = [
    ({}, []),
    ({"source": ""}, ["missing_source"]),
    ({"source_user_id": " \t"}, ["missing_source_user_id"]),
    ({"email": None}, ["missing_email"]),
    ({"username": " "}, ["missing_username"]),
    ({"username": "\x1c\x1f"}, ["missing_username", "text_field_has_control_characters:username"]),
    ({"country": "  "}, ["missing_country"]),
    ({"country": "Ruritania"}, ["unsupported_country"]),
    ({"country": "IRELAND"}, ["unsupported_country"]),
    ({"source": "crm", "country": "Bhutan", "country_code": "BT"}, []),
    ({"country_code": "Q9"}, ["invalid_country_code"]),
    ({"country_code": "iE"}, ["invalid_country_code"]),
    ({"country_code": None}, []),
    ({"date_of_birth": None}, ["missing_date_of_birth"]),
    ({"date_of_birth": "someday"}, ["invalid_date_of_birth"]),
    ({"date_of_birth": "08:15"}, ["invalid_date_of_birth"]),
    ({"date_of_birth": "1991"}, ["invalid_date_of_birth"]),
    ({"date_of_birth": "1991-7-3"}, ["invalid_date_of_birth"]),
    ({"date_of_birth": "1999-02-29"}, ["invalid_date_of_birth"]),
    ({"date_of_birth": "1980-06-23"}, []),
    ({"date_of_birth": "1980-06-23 10:00"}, []),
    ({"date_of_birth": "1980-06-23T10:00:00.123456+05:30"}, []),
    ({"date_of_birth": "1871-11-30T05:00:00Z"}, ["implausible_age"]),
    ({"date_of_birth": "2012-01-01", "registered_at": "2024-01-01"}, []),
    ({"date_of_birth": "2012-01-02", "registered_at": "2024-01-01"}, ["implausible_age"]),
    ({"date_of_birth": "1924-01-02"}, []),
    ({"date_of_birth": "1924-01-01"}, ["implausible_age"]),
    ({"date_of_birth": "2031-04-05T00:00:00Z"}, ["implausible_age", "registered_before_date_of_birth"]),
    ({"registered_at": None}, []),
    ({"registered_at": "a while ago"}, ["invalid_registered_at"]),
    ({"registered_at": "1975-08-09T00:00:00Z"}, ["registered_before_date_of_birth"]),
    ({"registered_at": "2025-01-01T23:59:59Z"}, []),
    ({"registered_at": "2025-01-01T23:59:59-01:00"}, ["registered_in_future"]),
    ({"registered_at": "2028-03-01", "date_of_birth": "2029-03-01"},
     ["implausible_age", "registered_before_date_of_birth", "registered_in_future"]),
    ({"latitude": "90.25"}, ["invalid_latitude"]),
    ({"latitude": "up"}, ["invalid_latitude"]),
    ({"latitude": "NaN"}, ["invalid_latitude"]),
    ({"latitude": "1d"}, ["invalid_latitude"]),
    ({"latitude": "-90"}, []),
    ({"latitude": None, "longitude": None}, []),
    ({"longitude": "-180.5"}, ["invalid_longitude"]),
    ({"nationality": "Irish"}, ["invalid_nationality"]),
    ({"nationality": "Ie"}, ["invalid_nationality"]),
    ({"nationality": "Q9"}, ["invalid_nationality"]),
    ({"timezone_offset": "3:45"}, []),
    ({"timezone_offset": "-12:00"}, []),
    ({"timezone_offset": "-12:01"}, ["invalid_timezone_offset"]),
    ({"timezone_offset": "+14:00"}, []),
    ({"timezone_offset": "+14:01"}, ["invalid_timezone_offset"]),
    ({"timezone_offset": "+19:30"}, ["invalid_timezone_offset"]),
    ({"timezone_offset": "+03:60"}, ["invalid_timezone_offset"]),
    ({"timezone_offset": "+003:00"}, ["invalid_timezone_offset"]),
    ({"timezone_offset": "+١:00"}, ["invalid_timezone_offset"]),
    ({"picture_large": "http://pics.hopper.net/1"}, ["invalid_picture_url:picture_large"]),
    ({"picture_medium": "HTTPS://pics.hopper.net/2"}, []),
    ({"picture_thumbnail": "https:///3"}, ["invalid_picture_url:picture_thumbnail"]),
    ({"picture_medium": LONG_URL},
     ["invalid_picture_url:picture_medium", "text_field_too_long:picture_medium"]),
    ({"first_name": "a" * 512}, []),
    ({"first_name": "é" * 512}, []),
    ({"first_name": "é" * 513}, ["text_field_too_long:first_name"]),
    ({"first_name": "Gr\tace"}, ["text_field_has_control_characters:first_name"]),
    ({"first_name": "Ada\n"}, []),
    ({"last_name": "x\x85y"}, ["text_field_has_control_characters:last_name"]),
    ({"city": "c" * 513 + "\x7fd", "gender": "\x00m"},
     ["text_field_has_control_characters:gender", "text_field_too_long:city", "text_field_has_control_characters:city"]),
]


def test_rules_give_the_full_ordered_reasons(spark):
    got = reasons(R.check_quality(frame(spark, [change for change, _ in CASES]), TODAY))
    wrong = [(change, want, have) for (change, want), have in zip(CASES, got, strict=True) if want != have]
    assert wrong == []


@pytest.mark.parametrize("offset", [f"{s}{h}:{m:02d}" for s in ("", "+", "-") for h in (0, 9, 11, 12, 13, 14, 15) for m in (0, 1, 59, 60)])
def test_offset_pattern_equals_the_arithmetic(spark, offset):
    import re

    sign = -1 if offset.startswith("-") else 1
    hours, minutes = (int(x) for x in offset.lstrip("+-").split(":"))
    fine = minutes <= 59 and -720 <= sign * (hours * 60 + minutes) <= 840
    assert bool(re.match(X.UTC_OFFSET.replace(r"\z", r"\Z"), offset)) == fine


def test_age_counts_leap_day_birthdays_from_march(spark):
    born = spark.createDataFrame([(dt.date(2000, 2, 29),)], "b date")
    ages = [born.select(X.age_on(F.col("b"), day)).first()[0] for day in (dt.date(2013, 2, 28), dt.date(2013, 3, 1), dt.date(2024, 2, 29))]
    assert ages == [12, 13, 24]


def test_users_can_add_rules_and_codes_must_be_clean(spark):
    people = frame(spark, [{}, {"gender": None}])
    extra = R.Rule("missing_gender", F.col("gender").isNull())
    assert reasons(R.check_quality(people, TODAY, extra_rules=[extra])) == [[], ["missing_gender"]]
    with pytest.raises(ValueError):
        R.joined_codes([R.Rule("a,b", F.lit(True))])
    with pytest.raises(ValueError):
        R.insert_after([extra], "no_such_rule", extra)


def test_country_codes_can_be_passed_in(spark):
    assert reasons(R.check_quality(frame(spark, [{}]), TODAY, country_codes=["GB"])) == [
        ["invalid_country_code", "invalid_nationality"]
    ]


def test_status_and_validity(spark):
    checked = R.with_status(R.check_quality(frame(spark, [{}, {"username": ""}]), TODAY), TODAY)
    rows = checked.orderBy("case").select("validation_status", "reason_count", "age_years", R.is_valid().alias("v")).collect()
    assert [tuple(r) for r in rows] == [("valid", 0, 44, True), ("invalid", 1, 44, False)]


def test_filters_on_reasons_do_not_repeat_the_rules(spark):
    checked = R.check_quality(frame(spark, [{}]), TODAY).filter(R.is_valid())
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("THEN missing_username END") == 1


def test_enrichment(spark):
    checked = R.check_quality(frame(spark, [{}]), TODAY)
    row = R.enrich(checked, TODAY, F.lit("2024-05-01 10:00:00")).first()
    assert row.ingested_at == dt.datetime(2024, 5, 1, 10) and row.processed_at is not None
    assert "ingested_at" not in R.enrich(checked, TODAY).columns

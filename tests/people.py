"""Hand-written profiles and responses for the rule tests."""

from __future__ import annotations

import copy
import datetime as dt
import json

from pyspark.sql import types as T

from profilegate import schemas as S

TODAY = dt.date(2025, 1, 1)

GOOD = {
    "source": "random_user",
    "source_user_id": "id-0001",
    "gender": "male",
    "title": "Mr",
    "first_name": "Alan",
    "last_name": "Turing",
    "street_number": 7,
    "street_name": "Adlington Road",
    "city": "Wilmslow",
    "state": "Cheshire",
    "country": "Ireland",
    "country_code": "IE",
    "postcode": "D02 AF30",
    "latitude": "53.3331",
    "longitude": "-6.2489",
    "timezone_offset": "+1:00",
    "timezone_description": "Dublin",
    "email": "alan@example.org",
    "username": "alan",
    "date_of_birth": "1980-06-23T00:00:00Z",
    "registered_at": "2023-03-04T05:06:07Z",
    "phone": "01 555 0100",
    "cell": "085 555 0100",
    "picture_large": "https://example.org/l.png",
    "picture_medium": "https://example.org/m.png",
    "picture_thumbnail": "https://example.org/t.png",
    "nationality": "IE",
}

SCHEMA = T.StructType(
    [T.StructField("case", T.IntegerType())]
    + [T.StructField(n, T.LongType() if n == "street_number" else T.StringType()) for n in S.PROFILE_FIELDS]
)

ITEM = {
    "gender": "male",
    "name": {"title": "Mr", "first": "Alan", "last": "Turing"},
    "location": {
        "street": {"number": 7, "name": "Adlington Road"},
        "city": "Wilmslow",
        "state": "Cheshire",
        "country": "Ireland",
        "postcode": "D02 AF30",
        "coordinates": {"latitude": "53.3331", "longitude": "-6.2489"},
        "timezone": {"offset": "+1:00", "description": "Dublin"},
    },
    "email": "alan@example.org",
    "login": {"uuid": "id-0001", "username": "alan"},
    "dob": {"date": "1980-06-23T00:00:00Z", "age": 44},
    "registered": {"date": "2023-03-04T05:06:07Z", "age": 1},
    "phone": "01 555 0100",
    "cell": "085 555 0100",
    "picture": {
        "large": "https://example.org/l.png",
        "medium": "https://example.org/m.png",
        "thumbnail": "https://example.org/t.png",
    },
    "nat": "IE",
}


def frame(spark, changes):
    """One profile per change set, each the good profile with some fields replaced."""
    rows = []
    for i, change in enumerate(changes):
        row = GOOD | change
        rows.append((i, *[row.get(n) for n in S.PROFILE_FIELDS]))
    return spark.createDataFrame(rows, SCHEMA)


def reasons(checked):
    return [r["rejection_reasons"] for r in checked.orderBy("case").select("rejection_reasons").collect()]


REMOVED = object()


def item(path: str = "", value=REMOVED) -> dict:
    """The source item with one nested value replaced, or removed."""
    out = copy.deepcopy(ITEM)
    if path:
        *parents, last = path.split(".")
        node = out
        for p in parents:
            node = node[p]
        if value is REMOVED:
            del node[last]
        else:
            node[last] = value
    return out


def body(*items) -> str:
    return json.dumps({"results": list(items), "info": {"results": len(items)}})


def response(i, body=None, *, attempt=0, expected=1, status=200, error=None):
    return (f"r{i:03d}", attempt, dt.datetime(2024, 1, 1, 0, 0, attempt), 1.0, expected, status, error, body)


def responses(spark, rows):
    return spark.createDataFrame(rows, S.RESPONSE_SCHEMA)

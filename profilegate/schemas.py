"""Row schemas, field contracts and fixed values."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache
from importlib import resources
from pathlib import Path
from zoneinfo import TZPATH

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------------------------
# These must equal the published event contracts, so they are stated as they are.

SCHEMA_VERSION = "1.0"
USER_CREATED_TYPE = "UserCreated"
USER_PROFILE_INVALID_TYPE = "UserProfileInvalid"
DEMO_SOURCE = "random_user"
CREATED_TOPIC = "users_created"
INVALID_TOPIC = "users_created_invalid"
# Where this job publishes what it found valid; it must not be a topic the job reads.
VALID_TOPIC = "users_valid"
PSEUDONYM_PREFIX = "sha256:"

MIN_AGE = 13
MAX_AGE = 100
MAX_TEXT_LENGTH = 512
MAX_URL_LENGTH = 2048

# Country names the demo source may use, with their ISO codes.
SOURCE_COUNTRY_CODES = {
    "Australia": "AU",
    "Brazil": "BR",
    "Canada": "CA",
    "Denmark": "DK",
    "Finland": "FI",
    "France": "FR",
    "Germany": "DE",
    "India": "IN",
    "Iran": "IR",
    "Ireland": "IE",
    "Mexico": "MX",
    "Netherlands": "NL",
    "New Zealand": "NZ",
    "Norway": "NO",
    "Serbia": "RS",
    "Spain": "ES",
    "Switzerland": "CH",
    "Turkey": "TR",
    "Ukraine": "UA",
    "United Kingdom": "GB",
    "United States": "US",
}

# The only payload fields an invalid event may carry.
PAYLOAD_FIELDS = ("schema_version", "event_type", "source", "country_code")

PICTURE_FIELDS = ("picture_large", "picture_medium", "picture_thumbnail")


@cache
def iso_country_codes() -> tuple[str, ...]:
    """ISO 3166-1 alpha-2 codes, read from the IANA time-zone database on the driver.

    Pass ``country_codes=`` to the rules instead where no copy of that database is installed.
    """
    copies = []
    try:
        copies.append(resources.files("tzdata") / "zoneinfo" / "iso3166.tab")
    except ModuleNotFoundError:
        pass
    copies.extend(Path(folder) / "iso3166.tab" for folder in TZPATH)
    for table in copies:
        if table.is_file():
            lines = table.read_text(encoding="utf-8").splitlines()
            return tuple(sorted(line.split("\t")[0] for line in lines if line and not line.startswith("#")))
    raise FileNotFoundError("no iso3166.tab found: install tzdata or pass country_codes explicitly")


# --- field contracts --------------------------------------------------------------------------


@dataclass(frozen=True)
class Field:
    """One field of an event: its wire type plus the constraints the contract puts on it."""

    name: str
    kind: str = "string"
    required: bool = False
    const: str | None = None
    exact_length: int | None = None
    bounds: tuple[float, float] | None = None
    fmt: str | None = None
    pattern: str | None = None


def _req(name: str, **kw) -> Field:
    return Field(name, required=True, **kw)


USER_CREATED_FIELDS = (
    _req("schema_version", const=SCHEMA_VERSION),
    _req("event_type", const=USER_CREATED_TYPE),
    _req("source"),
    _req("source_user_id"),
    Field("gender"),
    Field("title"),
    _req("first_name"),
    _req("last_name"),
    Field("street_number", kind="integer"),
    Field("street_name"),
    Field("city"),
    Field("state"),
    _req("country"),
    Field("country_code", exact_length=2),
    Field("postcode"),
    Field("latitude", kind="number", bounds=(-90.0, 90.0)),
    Field("longitude", kind="number", bounds=(-180.0, 180.0)),
    Field("timezone_offset"),
    Field("timezone_description"),
    _req("email", fmt="email"),
    _req("username"),
    _req("date_of_birth", fmt="date-time"),
    Field("registered_at", fmt="date-time"),
    Field("phone"),
    Field("cell"),
    Field("picture_large", fmt="uri"),
    Field("picture_medium", fmt="uri"),
    Field("picture_thumbnail", fmt="uri"),
    Field("nationality"),
)

USER_PROFILE_INVALID_FIELDS = (
    _req("schema_version", const=SCHEMA_VERSION),
    _req("event_type", const=USER_PROFILE_INVALID_TYPE),
    Field("source"),
    Field("source_user_id", pattern=r"^sha256:[0-9a-f]{64}$"),
    _req("rejection_reasons", kind="reasons"),
    Field("payload", kind="object"),
)

PROFILE_FIELDS = tuple(f.name for f in USER_CREATED_FIELDS)
# The mapped profile has no envelope fields yet.
NORMALIZED_FIELDS = PROFILE_FIELDS[2:]
# Fields whose text is checked for length and control characters, in reporting order.
TEXT_FIELDS = tuple(name for name in NORMALIZED_FIELDS if name != "street_number")


# --- Spark schemas ----------------------------------------------------------------------------


def _string_struct(names: tuple[str, ...], typed: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, typed.get(n, T.StringType())) for n in names])


NORMALIZED_SCHEMA = _string_struct(NORMALIZED_FIELDS, {"street_number": T.LongType()})

USER_CREATED_SCHEMA = _string_struct(
    PROFILE_FIELDS,
    {
        "street_number": T.LongType(),
        "latitude": T.DoubleType(),
        "longitude": T.DoubleType(),
        "date_of_birth": T.TimestampType(),
        "registered_at": T.TimestampType(),
    },
)

PAYLOAD_SCHEMA = _string_struct(PAYLOAD_FIELDS, {})

USER_PROFILE_INVALID_SCHEMA = _string_struct(
    tuple(f.name for f in USER_PROFILE_INVALID_FIELDS),
    {"rejection_reasons": T.ArrayType(T.StringType(), False), "payload": PAYLOAD_SCHEMA},
)

RESPONSE_SCHEMA = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("requested_at", T.TimestampType()),
        T.StructField("latency_ms", T.DoubleType()),
        T.StructField("expected_count", T.IntegerType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("transport_error", T.StringType()),
        T.StructField("body", T.StringType()),
    ]
)

EVENT_LOG_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

DELIVERY_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("record_id", T.LongType()),
        T.StructField("topic", T.StringType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)

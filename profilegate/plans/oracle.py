"""SQL a second engine runs on the same tables, to check each query against.

The statements restate what a query means in plain SQL: windows where the operators aggregate,
values computed from the key where the operators parse JSON.
"""

from __future__ import annotations

import datetime as dt

from profilegate import schemas as S
from profilegate.functions import text as X
from profilegate.functions.privacy import _pads
from profilegate.plans import fixtures as FX
from profilegate.plans import landed as L

TODAY = FX.REFERENCE_DATE


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def code_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


P = f"P AS ({FX.select_sql(FX.PROFILE_SQL)})"
RAW = f"RAW AS ({FX.select_sql(FX.RAW_SQL)})"
ISO = code_list(S.iso_country_codes())
NAMES = code_list(S.SOURCE_COUNTRY_CODES)
TYPED_DATES = ("date_of_birth", "registered_at")


def strip(c: str) -> str:
    return f"trim({c}, {q(X.WHITE_SPACE)})"


def blank(c: str) -> str:
    return f"({c} IS NULL OR trim({c}, {q(X.BLANK_SPACE)}) = '')"


def moment(c: str) -> str:
    """ISO text to a UTC timestamp, null where it is none."""
    shape = r"\d{4}-\d\d-\d\d([Tt _]\d\d:\d\d(:\d\d(\.\d{1,9})?)?([Zz]|[+-]\d\d:?\d\d)?)?"
    text = rf"regexp_replace(upper(replace({c}, '_', ' ')), '([+-]\d\d)(\d\d)$', '\1:\2')"
    zoned = rf"regexp_matches({text}, '(Z|[+-]\d\d:\d\d)$')"
    instant = f"CASE WHEN {zoned} THEN make_timestamp(epoch_us(try_cast({text} AS TIMESTAMPTZ))) ELSE try_cast({text} AS TIMESTAMP) END"
    return f"CASE WHEN regexp_full_match({c}, {q(shape)}) THEN {instant} END"


def number(c: str) -> str:
    shape = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"
    return f"CASE WHEN regexp_full_match({c}, {q(shape)}) THEN try_cast({c} AS DOUBLE) END"


def inside(c: str, low: int, high: int) -> str:
    return f"coalesce({c} >= {low} AND {c} <= {high}, false)"


def _only(c: str, allowed: str) -> str:
    """No character outside of ``allowed``."""
    return f"translate({c}, {q(allowed)}, '') = ''"


_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_DIGITS = "0123456789"


def email_ok(c: str) -> str:
    """Taken apart at @ and dots, and each part checked by its characters."""
    local, domain = f"string_split({c}, '@')[1]", f"lower(string_split({c}, '@')[2])"
    labels = f"string_split({domain}, '.')"
    last = f"list_extract({labels}, -1)"
    label = f"x <> '' AND length(x) <= 63 AND x[1] <> '-' AND x[-1] <> '-' AND {_only('x', _LETTERS + _DIGITS + '-')}"
    unwanted = "list_has_any(string_split(" + local + ", ''), string_split(' \"(),:;<>[]' || chr(92) || chr(9) || chr(10), ''))"
    return (
        f"(CASE WHEN {c} IS NULL THEN NULL ELSE len(string_split({c}, '@')) = 2 AND length({c}) <= 254 AND length({local}) BETWEEN 1 AND 64 "
        f"AND NOT list_contains(string_split({local}, '.'), '') AND NOT {unwanted} AND len({labels}) >= 2 "
        f"AND len(list_filter({labels}, lambda x: NOT ({label}))) = 0 AND {_only(last + '[-1]', _LETTERS)} "
        f"AND {last} NOT IN ('arpa', 'invalid', 'local', 'localhost', 'onion', 'test') END)"
    )


def http_ok(c: str) -> str:
    """Scheme, authority, host and port taken apart in turn."""
    authority = f"string_split_regex(substr({c}, strpos({c}, '://') + 3), '[/?#\\\\]')[1]"
    place = f"list_extract(string_split({authority}, '@'), -1)"
    closed = f"strpos({place}, ']')"
    bracketed = f"{place}[1] = '['"
    host = f"CASE WHEN {bracketed} THEN substr({place}, 2, {closed} - 2) ELSE string_split({place}, ':')[1] END"
    after = f"CASE WHEN {bracketed} THEN substr({place}, {closed} + 1) ELSE substr({place}, length(string_split({place}, ':')[1]) + 1) END"
    forbidden = "list_has_any(string_split(" + host + ", ''), string_split(' \"<>^|%{}`[]' || chr(9) || chr(10) || chr(92), ''))"
    good_host = f"CASE WHEN {bracketed} THEN {closed} > 2 AND {_only(f'lower({host})', 'abcdef:.' + _DIGITS)} ELSE ({host}) <> '' AND NOT {forbidden} END"
    good_port = f"(({after}) IN ('', ':') OR (({after})[1] = ':' AND length({after}) <= 6 AND {_only(f'({after})[2:]', _DIGITS)} AND coalesce(TRY_CAST(({after})[2:] AS INT), 0) <= 65535))"
    return (
        f"(CASE WHEN {c} IS NULL THEN NULL ELSE lower(split_part({c}, '://', 1)) IN ('http', 'https') AND strpos({c}, '://') > 0 "
        f"AND len(string_split({authority}, '@')) <= 2 AND strpos({authority}, ' ') = 0 AND ({good_host}) AND {good_port} END)"
    )


def control(c: str) -> str:
    return rf"regexp_matches({c}, '[\x00-\x1f\x7f\x{{80}}-\x{{9f}}]')"


def https_ok(c: str) -> str:
    return f"(regexp_matches({c}, '^(?i:https)://[^/?#]') AND length({c}) <= 2048 AND NOT {control(c)})"


def age(c: str) -> str:
    born = f"CAST({c} AS DATE)"
    return (
        f"({TODAY.year} - year({born}) - CASE WHEN {TODAY.month * 100 + TODAY.day} < month({born}) * 100 + day({born}) "
        "THEN 1 ELSE 0 END)"
    )


# --- profiles ---------------------------------------------------------------------------------

# Stripped text columns, the e-mail domain in lower case.
_domain = (
    "CASE WHEN strpos(email, '@') > 0 THEN left(email, strpos(email, '@') - 1) || '@' || "
    "lower(list_extract(string_split(email, '@'), -1)) ELSE email END"
)


def stripped(source: str, typed: bool) -> str:
    keep = TYPED_DATES if typed else ()
    columns = [n if n in keep else f"{strip(n)} AS {n}" for n in S.TEXT_FIELDS]
    envelope = [] if typed else [
        f"coalesce({strip('schema_version')}, '1.0') AS schema_version",
        f"coalesce({strip('event_type')}, 'UserCreated') AS event_type",
    ]
    extra = [] if typed else []
    return f"SELECT k, street_number, {', '.join([*envelope, *extra, *columns])} FROM {source}"


def parsed(source: str, typed: bool) -> str:
    date = (lambda c: f"CAST({c} AS TIMESTAMP)") if typed else moment
    return (
        f"SELECT * REPLACE ({_domain} AS email), {date('date_of_birth')} AS birth, {date('registered_at')} AS reg, "
        f"{number('latitude')} AS lat, {number('longitude')} AS lon FROM {source}"
    )


def reason_list(typed: bool, structural: bool) -> list[tuple[str, str]]:
    born = "birth IS NOT NULL" if typed else f"NOT {blank('date_of_birth')}"
    out = []
    if structural:
        if not typed:
            out += [
                ("contract_violation:schema_version", "schema_version <> '1.0'"),
                ("contract_violation:event_type", "event_type <> 'UserCreated'"),
            ]
        out += [(f"contract_violation:{n}", f"coalesce({n}, '') = ''") for n in ("first_name", "last_name")]
    out += [
        ("missing_source", blank("source")),
        ("missing_source_user_id", blank("source_user_id")),
        ("missing_email", blank("email")),
    ]
    if structural:
        out.append(("invalid_email", f"NOT {blank('email')} AND NOT {email_ok('email')}"))
    out += [
        ("missing_username", blank("username")),
        ("missing_country", blank("country")),
        ("unsupported_country", f"source = 'random_user' AND NOT {blank('country')} AND country NOT IN {NAMES}"),
        ("invalid_country_code", f"country_code NOT IN {ISO}"),
        ("missing_date_of_birth", f"NOT ({born})"),
        ("invalid_date_of_birth", f"({born}) AND birth IS NULL"),
        ("implausible_age", f"{age('birth')} NOT BETWEEN 13 AND 100"),
        ("invalid_registered_at", "registered_at IS NOT NULL AND reg IS NULL"),
        ("registered_before_date_of_birth", "reg < birth"),
        ("registered_in_future", f"CAST(reg AS DATE) > DATE '{TODAY}'"),
        ("invalid_latitude", f"latitude IS NOT NULL AND NOT {inside('lat', -90, 90)}"),
        ("invalid_longitude", f"longitude IS NOT NULL AND NOT {inside('lon', -180, 180)}"),
        ("invalid_nationality", f"nationality NOT IN {ISO}"),
        (
            "invalid_timezone_offset",
            r"NOT regexp_full_match(timezone_offset, '[+-]?\d{1,2}:\d{2}') OR "
            "(regexp_full_match(timezone_offset, '[+-]?[0-9]{1,2}:[0-9]{2}') AND (try_cast(right(timezone_offset, 2) AS INT) > 59 OR "
            "(CASE WHEN left(timezone_offset, 1) = '-' THEN -1 ELSE 1 END) * "
            "(try_cast(ltrim(split_part(timezone_offset, ':', 1), '+-') AS INT) * 60 + try_cast(right(timezone_offset, 2) AS INT)) "
            "NOT BETWEEN -720 AND 840))",
        ),
    ]
    for n in S.PICTURE_FIELDS:
        bad = f"NOT {https_ok(n)}" + (f" OR NOT {http_ok(n)}" if structural else "")
        out.append((f"invalid_picture_url:{n}", bad))
    for n in S.TEXT_FIELDS:
        if typed and n in TYPED_DATES:
            continue
        limit = 2048 if n in S.PICTURE_FIELDS else 512
        out.append((f"text_field_too_long:{n}", f"length({n}) > {limit}"))
        out.append((f"text_field_has_control_characters:{n}", control(n)))
    return out


def reasons(pairs: list[tuple[str, str]]) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {cond} THEN {q(code)} END" for code, cond in pairs) + ")"


def _checked(base: str, typed: bool, structural: bool) -> str:
    cte = P if base == "P" else RAW
    return (
        f"{cte}, S AS ({stripped(base, typed)}), D AS ({parsed('S', typed)}), "
        f"Q AS (SELECT *, {reasons(reason_list(typed, structural))} AS reasons FROM D)"
    )


QUALITY = "WITH " + _checked("P", True, False)
STRUCTURAL = "WITH " + _checked("RAW", False, True)
STRUCTURAL_P = "WITH " + _checked("P", True, True)
EVENTS = "E AS (SELECT o_orderkey AS event_id, o_orderdate AS ingested_at, Q.* FROM orders JOIN Q ON o_custkey = k)"
HOT_EVENTS = (
    f"WITH {P}, H AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'random_user' ELSE source END AS source, "
    "CASE WHEN o_orderkey % 3 = 0 THEN 'user-hot' ELSE source_user_id END AS source_user_id, "
    "o_orderkey AS event_id, o_orderdate AS ingested_at, username FROM orders JOIN P ON o_custkey = k)"
)
PREPARED = f"WITH {RAW}, S AS ({stripped('RAW', False)}), D AS ({parsed('S', False)})"


def _blob(data: bytes) -> str:
    return "'" + "".join(f"\\x{b:02x}" for b in data) + "'::BLOB"


def hmac(message: str, salt: str = FX.SALT) -> str:
    inner, outer = _pads(salt)
    return f"sha256({_blob(outer)} || unhex(sha256({_blob(inner)} || encode({message}))))"


PSEUDONYM = f"'sha256:' || {hmac(chr(39).join(['source || ', ':', ' || source_user_id']))}"
STATUS = "CASE WHEN reasons = '' THEN 'valid' ELSE 'invalid' END"

# --- responses --------------------------------------------------------------------------------

LUCK = "(k * 7 + attempt * 3) % 11"
_DOCUMENT = {1: "empty_results", 2: "unexpected_response", 3: "unexpected_response", 4: "invalid_json", 5: "invalid_json", 6: "unexpected_response"} | dict.fromkeys((7, 8, 9), "invalid_json")
# What keeps either of the two items of a response from being mapped.
BAD_ITEM = (
    "(coalesce(first_name, '') = '' OR coalesce(date_of_birth, '') = '' OR coalesce(username, '') = '' OR k % 157 = 1 "
    "OR k % 149 IN (1, 2, 3) OR k % 151 IN (1, 2, 3, 4) OR k % 163 IN (1, 2, 4))"
)
RESPONSE_REASON = (
    f"CASE WHEN {LUCK} = 1 THEN 'timeout' WHEN {LUCK} = 2 THEN 'http_error' WHEN {LUCK} = 3 THEN 'http_429' "
    f"WHEN {LUCK} = 4 THEN 'http_503' WHEN {LUCK} = 5 THEN 'http_404' "
    + " ".join(f"WHEN k % 167 = {i} THEN '{reason}'" for i, reason in _DOCUMENT.items())
    + f" WHEN {BAD_ITEM} THEN 'invalid_payload' WHEN k % 173 = 1 THEN 'unexpected_response' ELSE 'ok' END"
)
RESPONSES = (
    f"{RAW}, A AS (SELECT RAW.*, CAST(attempt AS INT) AS attempt FROM RAW, (SELECT unnest([0, 1, 2]) AS attempt)), "
    f"R AS (SELECT *, 'r' || k AS request_id, {RESPONSE_REASON} AS reason FROM A), "
    "C AS (SELECT *, reason IN ('timeout', 'http_error', 'http_429', 'empty_results') OR reason LIKE 'http_5%' AS retryable FROM R)"
)


def _normalized() -> str:
    values = {n: n for n in S.NORMALIZED_FIELDS}
    codes = " ".join(f"WHEN {q(name)} THEN '{code}'" for name, code in S.SOURCE_COUNTRY_CODES.items())
    values |= {
        "source": "'random_user'",
        "source_user_id": "source_user_id || CASE WHEN position = 1 THEN '-b' ELSE '' END",
        "country_code": f"CASE country {codes} END",
        "street_number": "CASE WHEN k % 151 = 5 THEN NULL ELSE street_number END",
        "postcode": "CASE WHEN k % 149 = 4 THEN '123456789012345678901234567890' WHEN k % 149 = 5 THEN NULL ELSE postcode END",
        "latitude": "CASE WHEN k % 5 = 4 THEN NULL ELSE latitude END",
        "longitude": "CASE WHEN k % 5 = 4 THEN NULL ELSE longitude END",
        "timezone_offset": "CASE WHEN k % 163 = 3 AND position = 1 THEN NULL ELSE timezone_offset END",
        "registered_at": "CASE WHEN k % 6 = 5 THEN NULL ELSE registered_at END",
    }
    values |= {n: f"CASE WHEN k % 8 = 7 THEN NULL ELSE {n} END" for n in S.PICTURE_FIELDS}
    return ", ".join(f"{expr} AS {n}" for n, expr in values.items())


# --- messages ---------------------------------------------------------------------------------

# Each text field of a created message, as it reads on the wire.
WIRE_TEXT_RULES = {f.name: f for f in S.USER_CREATED_FIELDS if f.kind == "string"}


def _wire_violation(f: S.Field) -> str:
    n = f.name
    if n == "schema_version":
        return "k % 157 = 3 OR coalesce(schema_version, '') <> '1.0'"
    if n == "event_type":
        return "coalesce(event_type, '') <> 'UserCreated'"
    if n == "street_number":
        return "k % 151 IN (2, 3, 4)"
    if n == "latitude":
        return "k % 13 IN (4, 5)"
    if n == "longitude":
        return "longitude IS NOT NULL"  # sent as text, where the contract wants a number
    if n == "email":
        return f"k % 157 = 2 OR NOT {email_ok('email')}"
    if f.fmt == "date-time":
        missing = f"{n} IS NULL OR " if f.required else f"{n} IS NOT NULL AND "
        return f"{missing}({moment(n)}) IS NULL"
    if f.fmt == "uri":
        return f"NOT {http_ok(n)}"
    if f.exact_length:
        return f"length({n}) <> {f.exact_length}"
    return f"coalesce({n}, '') = ''" if f.required else "false"


def wire_pairs() -> list[tuple[str, str]]:
    extra = [("contract_violation:additional_properties", "k % 157 IN (1, 2)")]
    return extra + [(f"contract_violation:{f.name}", _wire_violation(f)) for f in S.USER_CREATED_FIELDS]


def second_version() -> list[tuple[str, str]]:
    """Of the second version of the contract: ``extra`` may be there, and a latitude out of bounds or in text."""
    free = {"contract_violation:latitude": "false", "contract_violation:additional_properties": "k % 157 = 2"}
    return [(code, free.get(code, condition)) for code, condition in wire_pairs()]


TOPIC = "CASE WHEN k % 179 = 1 THEN 'other_topic' ELSE 'users_created' END"
CREATED_VIOLATIONS = (
    f"CASE WHEN k % 157 BETWEEN 4 AND 10 THEN 'invalid_json' ELSE {reasons(wire_pairs())} END"
)
INVALID_VIOLATIONS = reasons(
    [
        ("contract_violation:source_user_id", "k % 11 IN (1, 2)"),
        ("contract_violation:rejection_reasons", "k % 7 IN (1, 2, 3)"),
        ("contract_violation:payload", "k % 7 IN (5, 6)"),
    ]
)

# The profile fields a streaming job reads back from a message: values of the right JSON kind only.
WIRE = (
    "W AS (SELECT * REPLACE (CASE WHEN k % 157 = 3 THEN NULL ELSE schema_version END AS schema_version, "
    "CASE WHEN k % 157 = 2 THEN NULL ELSE email END AS email, NULL::VARCHAR AS longitude, "
    "CASE WHEN k % 13 = 4 THEN '97.25' WHEN k % 13 IN (5, 6) THEN NULL WHEN k % 13 = 7 THEN '-90' ELSE '48.8584' END AS latitude) FROM RAW)"
)
COVERED = {
    "source": ["missing_source"],
    "source_user_id": ["missing_source_user_id"],
    "email": ["missing_email", "invalid_email"],
    "username": ["missing_username"],
    "country": ["missing_country"],
    "country_code": ["invalid_country_code"],
    "date_of_birth": ["missing_date_of_birth", "invalid_date_of_birth"],
    "registered_at": ["invalid_registered_at"],
    "latitude": ["invalid_latitude"],
    "longitude": ["invalid_longitude"],
} | {n: [f"invalid_picture_url:{n}"] for n in S.PICTURE_FIELDS}


def _stream_route() -> str:
    wire = wire_pairs()
    flags = ", ".join(f"coalesce({cond}, false) AS w_{code.split(':')[1]}" for code, cond in wire)
    model = [
        (c, cond) for c, cond in reason_list(False, True)
        if not c.endswith((":latitude", ":longitude"))  # numbers by now, so no text rules
    ]
    model_flags = ", ".join(f"coalesce({cond}, false) AS m_{i}" for i, (_, cond) in enumerate(model))
    at = {code: i for i, (code, _) in enumerate(model)}
    parts = []
    for code, _ in wire:
        name = code.split(":")[1]
        cover = "".join(f" AND NOT m_{at[c]}" for c in COVERED.get(name, []))
        parts.append(f"CASE WHEN w_{name}{cover} THEN {q(code)} END")
    for code, i in at.items():
        twice = f" AND NOT w_{code.split(':')[1]}" if code.startswith("contract_violation:") else ""
        parts.append(f"CASE WHEN m_{i}{twice} THEN {q(code)} END")
    broken = "(k % 157 BETWEEN 4 AND 10 OR k % 181 = 1)"
    listed = "'[\"' || replace(reasons, ',', '\",\"') || '\"]'"
    return (
        f"WITH {RAW}, {WIRE}, S AS ({stripped('W', False)}), D AS ({parsed('S', False)}), "
        f"WF AS (SELECT k AS wk, {flags} FROM RAW), MF AS (SELECT *, {model_flags} FROM D), "
        f"Q AS (SELECT MF.*, CASE WHEN {broken} THEN 'invalid_json' ELSE concat_ws(',', {', '.join(parts)}) END AS reasons "
        "FROM MF JOIN WF ON k = wk) "
        "SELECT CASE WHEN reasons = '' THEN 'users_valid' ELSE 'users_created_invalid' END AS topic, "
        f"CASE WHEN {broken} OR source_user_id = '' THEN NULL WHEN reasons = '' THEN source_user_id ELSE {PSEUDONYM} END AS key, "
        f"CASE WHEN reasons <> '' THEN {listed} END AS reasons, "
        "CASE WHEN reasons = '' THEN username END AS username, "
        "CASE WHEN reasons = '' THEN 'valid' ELSE 'invalid' END AS validation_status, "
        "CAST(CASE WHEN reasons = '' THEN 0 ELSE len(string_split(reasons, ',')) END AS INT) AS reason_count FROM Q"
    )


# --- operations -------------------------------------------------------------------------------

LOG = (
    "G AS (SELECT event_id AS record_id, 'b' || (event_id // 20) AS batch_id, "
    "CASE WHEN event_id % 20 = 7 AND (event_id // 20) % 5 = 1 THEN 'error' "
    "WHEN event_id % 20 = 7 AND (event_id // 20) % 5 = 2 THEN NULL "
    "WHEN event_id % 20 = 3 AND (event_id // 20) % 5 = 2 THEN 'error' ELSE 'ack' END AS outcome, "
    "NOT (event_id % 20 = 7 AND (event_id // 20) % 5 = 3) AS complete FROM events)"
)
ATTEMPTS = (
    "A AS (SELECT CASE WHEN user_id % 3 = 0 THEN 'crm' ELSE 'random_user' END AS source, "
    "CASE WHEN event_type <> 'error' THEN 'ok' WHEN value > 40 THEN 'timeout' WHEN user_id % 2 = 0 THEN 'http_503' "
    "ELSE 'empty_results' END AS reason, "
    "CASE WHEN event_type = 'error' THEN 'source_failed' WHEN value > 60 THEN 'publish_failed' "
    "WHEN event_type = 'signup' THEN 'invalid' ELSE 'created' END AS signal FROM events)"
)


def _slots(step: int) -> str:
    return (
        "T AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'ingestion' ELSE 'publish' END AS sli, "
        f"CAST(floor(epoch_us(ts) / {step * 1_000_000}) AS BIGINT) * {step} AS slot, count(*) AS total, "
        "count(*) FILTER (WHERE NOT (event_type = 'error' AND value > 5)) AS good FROM events GROUP BY ALL)"
    )


WATERMARK = "(SELECT epoch_us(max(ts)) - 600000000 FROM events)"


def _percentiles() -> str:
    return (
        "WITH O AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS rn, "
        "count(*) OVER (PARTITION BY event_type) AS rows FROM events), "
        "W AS (SELECT unnest([500, 950, 990]) AS per_mille) "
        "SELECT event_type, CAST(per_mille AS INT) AS per_mille, rows, value FROM O, W "
        "WHERE rn = (rows * per_mille + 999) // 1000"
    )


def _histogram() -> str:
    from profilegate.operators.metrics import LATENCY_BOUNDS

    parts = [
        f"SELECT event_type, '{b}' AS upper_bound, count(*) FILTER (WHERE value <= {b}) AS rows FROM events GROUP BY event_type"
        for b in LATENCY_BOUNDS
    ]
    parts.append("SELECT event_type, 'Infinity' AS upper_bound, count(value) AS rows FROM events GROUP BY event_type")
    return " UNION ALL ".join(parts)


def statements() -> dict[str, str]:
    required = [f.name for f in S.USER_CREATED_FIELDS if f.required]
    missing = reasons([(n, f"coalesce({n}, '') = ''") for n in required])
    payload = "'1.0' AS payload_schema_version, 'UserCreated' AS payload_event_type, source AS payload_source, country_code AS payload_country_code"
    codes = " ".join(f"WHEN {q(name)} THEN '{code}'" for name, code in S.SOURCE_COUNTRY_CODES.items())
    typed = {
        "street_number": "street_number", "latitude": "lat", "longitude": "lon",
        "date_of_birth": "epoch_us(birth)", "registered_at": "epoch_us(reg)",
    }
    event = ", ".join(f"{typed.get(n, n)} AS {n}" for n in S.PROFILE_FIELDS)
    in_period = f"CAST(ingested_at AS DATE) > DATE '{L.RETENTION_TODAY - dt.timedelta(days=L.RETENTION_DAYS)}'"
    start, end = (int(t.timestamp()) for t in (L.REPLAY_START, L.REPLAY_END))
    framed = "k % 7 <> 0"

    def json_bytes(c: str) -> str:  # length of a JSON string literal
        escapes = f"(length({c}) - length(replace({c}, chr(9), '')))"
        return f"(octet_length(encode({c})) + {escapes})"

    return {
        "quality_reasons": f"{QUALITY} SELECT k, reasons FROM Q",
        "quality_status": f"{QUALITY} SELECT k, {STATUS} AS validation_status, "
        "CAST(CASE WHEN reasons = '' THEN 0 ELSE len(string_split(reasons, ',')) END AS INT) AS reason_count, "
        f"CAST({age('birth')} AS INT) AS age_years FROM Q",
        "text_rules_documents": f"WITH T AS (SELECT doc_id, {strip('text')} AS text FROM documents) "
        "SELECT doc_id, CAST(length(text) AS INT) AS chars, "
        + reasons([("text_field_too_long:text", "length(text) > 512"), ("text_field_has_control_characters:text", control("text"))])
        + " AS reasons FROM T",
        "contract_strip_required": f"{PREPARED} SELECT k, source, first_name, country_code, {missing} AS missing, "
        "coalesce(length(country_code) = 2, true) AS code_length_ok FROM D",
        "contract_email": f"{PREPARED} SELECT k, email, {email_ok('email')} AS ok FROM D",
        "contract_coordinates": f"{PREPARED} SELECT k, lat AS latitude, (latitude IS NULL OR {inside('lat', -90, 90)}) AS latitude_ok, "
        f"(longitude IS NULL OR {inside('lon', -180, 180)}) AS longitude_ok FROM D",
        "contract_datetime": f"{PREPARED} SELECT k, epoch_us(birth) AS born_us, epoch_us(reg) AS registered_us FROM D",
        "contract_url": f"{PREPARED}, U AS (SELECT 'profile-' || k AS id, picture_large AS url FROM D "
        f"UNION ALL SELECT 'page-' || page_id, url FROM pages) SELECT id, {http_ok('url')} AS http_ok, {https_ok('url')} AS https_ok FROM U",
        "contract_profiles": f"{STRUCTURAL} SELECT k, reasons FROM Q",
        "contract_extra_fields": f"WITH {RAW}, V AS (SELECT k, k % 179 <> 1 AND k % 157 NOT BETWEEN 4 AND 10 AS judged, "
        "k % 157 IN (1, 2) AS extra, (k % 157 = 3 OR coalesce(schema_version, '') <> '1.0') AS version, "
        "coalesce(event_type, '') <> 'UserCreated' AS kind FROM RAW) "
        "SELECT k, judged AND extra AS additional_properties, judged AND version AS schema_version, judged AND kind AS event_type FROM V",
        "contract_conformance": f"WITH {RAW}, M AS (SELECT k, {TOPIC} AS topic, {CREATED_VIOLATIONS} AS found FROM RAW "
        f"UNION ALL SELECT c_custkey AS k, 'users_created_invalid', {INVALID_VIOLATIONS.replace('k %', 'c_custkey %')} {FX.FROM_SQL}) "
        "SELECT k, topic, topic || '-value' AS subject, CASE WHEN topic = 'other_topic' THEN 'no_contract' ELSE found END AS violations FROM M",
        "normalize_profiles": f"WITH {RESPONSES} SELECT request_id, attempt, CAST(position AS INT) AS position, {_normalized()} "
        "FROM C, (SELECT unnest([0, 1]) AS position) WHERE reason = 'ok'",
        "classify_responses": f"WITH {RESPONSES} SELECT request_id, attempt, reason, retryable FROM C",
        "response_scan": f"WITH {RESPONSES}, L AS (SELECT CASE WHEN k % 191 = 1 THEN 'invalid_request' ELSE reason END AS reason FROM C) "
        "SELECT reason, count(*) AS attempts, reason IN ('timeout', 'http_error', 'http_429', 'empty_results') OR reason LIKE 'http_5%' AS retryable "
        "FROM L GROUP BY 1",
        "resolve_attempts": f"WITH {RESPONSES}, N AS (SELECT request_id, attempt, reason, retryable, "
        "coalesce(bool_or(NOT retryable) OVER (PARTITION BY request_id ORDER BY attempt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS over FROM C) "
        "SELECT request_id, arg_max(reason, attempt) AS outcome, CAST(max(attempt) + 1 AS INT) AS attempts_made FROM N WHERE NOT over GROUP BY request_id",
        "stream_attempts": f"WITH {RESPONSES}, N AS (SELECT request_id, attempt, reason, retryable, "
        "coalesce(bool_or(NOT retryable) OVER (PARTITION BY request_id ORDER BY attempt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS over FROM C) "
        "SELECT request_id, arg_max(reason, attempt) AS outcome, CAST(max(attempt) + 1 AS INT) AS attempts_made FROM N WHERE NOT over GROUP BY request_id",
        "country_code_lookup": f"WITH {P} SELECT k, country, CASE country {codes} END AS derived_code FROM P",
        "pseudonymize": f"WITH {P} SELECT k, {PSEUDONYM} AS pseudonym FROM P",
        "invalid_events": f"{QUALITY} SELECT '1.0' AS schema_version, 'UserProfileInvalid' AS event_type, source, {PSEUDONYM} AS source_user_id, "
        f"reasons, {payload} FROM Q WHERE reasons <> ''",
        "valid_events": f"{STRUCTURAL} SELECT {event} FROM Q WHERE reasons = ''",
        "route_topics": f"{STRUCTURAL_P}, V AS (SELECT *, reasons = '' AS ok FROM Q) "
        "SELECT k, CASE WHEN ok THEN 'users_valid' ELSE 'users_created_invalid' END AS topic, "
        f"CASE WHEN ok THEN source_user_id ELSE {PSEUDONYM} END AS key, CAST(CASE WHEN ok THEN 1 ELSE 2 END AS BIGINT) AS schema_id, "
        "CASE WHEN ok THEN 'UserCreated' ELSE 'UserProfileInvalid' END AS event_type, "
        f"CASE WHEN ok THEN source_user_id ELSE {PSEUDONYM} END AS source_user_id, "
        "CASE WHEN ok THEN strftime(birth, '%Y-%m-%dT%H:%M:%SZ') END AS date_of_birth, "
        "CASE WHEN ok AND lat IS NOT NULL THEN CAST(lat AS VARCHAR) END AS latitude, CAST(CASE WHEN ok THEN 29 ELSE 6 END AS INT) AS fields FROM V",
        "frame_roundtrip": f"WITH {P} SELECT k, CAST(5 + octet_length(encode('{{\"source_user_id\":\"\",\"first_name\":\"\",\"phone\":\"\"}}')) "
        f"+ {json_bytes('source_user_id')} + {json_bytes('first_name')} + {json_bytes('phone')} AS INT) AS bytes, "
        f"CAST(CASE WHEN {framed} THEN 70000 END AS BIGINT) AS schema_id, CASE WHEN {framed} THEN source_user_id END AS source_user_id, "
        f"CASE WHEN {framed} THEN first_name END AS first_name, CASE WHEN {framed} THEN phone END AS phone FROM P",
        "delivery_outcome": f"WITH {LOG}, N AS (SELECT batch_id, count(*) AS records, "
        "count(*) FILTER (WHERE outcome = 'ack' AND complete) AS acknowledged, count(*) FILTER (WHERE outcome = 'error') AS errors, "
        "count(*) FILTER (WHERE outcome IS NULL) AS undelivered FROM G GROUP BY batch_id) "
        "SELECT *, CASE WHEN undelivered > 0 THEN 'delivery_timeout' WHEN errors > 0 THEN 'delivery_failed' "
        "WHEN acknowledged <> records THEN 'delivery_not_acknowledged' ELSE 'ok' END AS result FROM N",
        "delivery_outcome_single": f"WITH {LOG} SELECT CASE WHEN outcome = 'error' THEN 'delivery_failed' "
        "WHEN outcome IS NULL OR NOT complete THEN 'delivery_not_acknowledged' ELSE 'ok' END AS result, count(*) AS publications FROM G GROUP BY 1",
        "unacknowledged_records": f"WITH {LOG} SELECT batch_id, record_id FROM G WHERE outcome IS NULL OR outcome = 'error' OR NOT complete",
        "counters_status": f"{QUALITY} SELECT {STATUS} AS validation_status, source, count(*) AS profiles FROM Q GROUP BY 1, 2",
        "counters_reason": f"{QUALITY}, R AS (SELECT source, unnest(string_split(reasons, ',')) AS reason FROM Q WHERE reasons <> '') "
        "SELECT source, reason, count(*) AS profiles FROM R GROUP BY 1, 2",
        "counters_all": f"{QUALITY}, {EVENTS}, R AS (SELECT {STATUS} AS validation_status, source, NULL AS reason FROM E UNION ALL "
        "SELECT 'invalid', source, unnest(string_split(reasons, ',')) FROM E WHERE reasons <> '') "
        "SELECT validation_status, source, reason, count(*) AS profiles FROM R GROUP BY 1, 2, 3",
        "counters_rollup": f"{QUALITY}, V AS (SELECT {STATUS} AS validation_status, source FROM Q) SELECT validation_status, source, "
        "CAST(grouping(validation_status) * 2 + grouping(source) AS INT) AS level, count(*) AS profiles FROM V GROUP BY ROLLUP (validation_status, source)",
        "profiles_by_country": f"{QUALITY} SELECT country, count(*) AS profiles FROM Q WHERE reasons = '' GROUP BY country",
        "failures_by_reason": f"WITH {ATTEMPTS}, N AS (SELECT source, reason, count(*) AS attempts FROM A GROUP BY 1, 2) "
        "SELECT source, reason, attempts, round(attempts / sum(attempts) OVER (PARTITION BY source), 6) AS rate FROM N",
        "latency_summary": _percentiles(),
        "latency_histogram": _histogram(),
        "signal_totals": f"WITH {ATTEMPTS} SELECT source, count(*) AS attempts, "
        + ", ".join(f"count(*) FILTER (WHERE signal = '{s}') AS {s}" for s in ("created", "invalid", "publish_failed", "source_failed"))
        + " FROM A GROUP BY source",
        "success_rate_24h": f"WITH {_slots(1800)}, R AS (SELECT sli, slot, CAST(sum(good) OVER w AS BIGINT) AS good, CAST(sum(total) OVER w AS BIGINT) AS total "
        "FROM T WINDOW w AS (PARTITION BY sli ORDER BY slot RANGE BETWEEN 84600 PRECEDING AND CURRENT ROW)) "
        "SELECT sli, slot, good, total, round(good / total, 6) AS success_rate, good / total >= 0.99 AS meets_target FROM R",
        "invalid_without_reason": f"{QUALITY} SELECT count(*) AS invalid_events, CAST(0 AS BIGINT) AS without_reason, "
        "CAST(1.0 AS DOUBLE) AS with_reason_share, false AS alert FROM Q WHERE reasons <> ''",
        "burn_rate_alerts": f"WITH {_slots(1800)}, B AS (SELECT *, round((1 - good / total) / (1 - 0.99::DOUBLE), 6) AS burn_rate FROM T) "
        "SELECT sli, slot, total, good, burn_rate, count(*) FILTER (WHERE burn_rate > 2) OVER (PARTITION BY sli ORDER BY slot "
        "RANGE BETWEEN 5400 PRECEDING AND CURRENT ROW) = 4 AS alert FROM B",
        "p99_alerts": "WITH O AS (SELECT event_type, CAST(floor(epoch_us(ts) / 7200000000) AS BIGINT) * 7200 AS slot, value, "
        "row_number() OVER w AS rn, count(*) OVER (PARTITION BY event_type, floor(epoch_us(ts) / 7200000000)) AS n FROM events "
        "WINDOW w AS (PARTITION BY event_type, floor(epoch_us(ts) / 7200000000) ORDER BY value)), "
        "B AS (SELECT event_type, slot, count(*) AS total, count(*) FILTER (WHERE value <= 60) AS within, "
        "max(value) FILTER (WHERE rn = (n * 99 + 99) // 100) > 60 AS p99_breached FROM O GROUP BY 1, 2) "
        "SELECT *, count(*) FILTER (WHERE p99_breached) OVER (PARTITION BY event_type ORDER BY slot "
        "RANGE BETWEEN 21600 PRECEDING AND CURRENT ROW) = 4 AS alert FROM B",
        "latest_valid": f"{QUALITY}, {EVENTS} SELECT event_id, epoch_us(ingested_at) AS ingested_us, source_user_id, country FROM E "
        "WHERE reasons = '' ORDER BY ingested_at DESC, event_id LIMIT 100",
        "latest_per_user": f"WITH {P}, E AS (SELECT *, row_number() OVER (PARTITION BY source, source_user_id ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn "
        "FROM orders JOIN P ON o_custkey = k) SELECT source, source_user_id, o_orderkey AS event_id, epoch_us(o_orderdate) AS ingested_us, username FROM E WHERE rn = 1",
        "invalid_by_reason_time": f"{QUALITY}, {EVENTS}, R AS (SELECT unnest(string_split(reasons, ',')) AS reason, event_id, ingested_at, source, source_user_id FROM E WHERE reasons <> ''), "
        "N AS (SELECT *, row_number() OVER (PARTITION BY reason ORDER BY ingested_at DESC, event_id) AS rank FROM R) "
        f"SELECT reason, CAST(rank AS INT) AS rank, event_id, epoch_us(ingested_at) AS processed_us, {PSEUDONYM} AS source_user_id FROM N WHERE rank <= 3",
        "view_partitioned": f"{STRUCTURAL_P}, {EVENTS} SELECT event_id, source_user_id, country, CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS load_id "
        f"FROM E WHERE reasons = '' AND (event_id % 2 = 1 OR country < '{L.SECOND_LOAD_BELOW}')",
        "view_latest_valid": f"{STRUCTURAL_P}, {EVENTS} SELECT CAST(date_trunc('month', ingested_at) AS DATE) AS event_date, count(*) AS events, "
        "arg_max(event_id, (ingested_at, event_id)) AS newest FROM E WHERE reasons = '' GROUP BY 1",
        "view_invalid_by_reason": f"{QUALITY}, {EVENTS} SELECT unnest(string_split(reasons, ',')) AS reason, "
        "CAST(date_trunc('month', ingested_at) AS DATE) AS event_date, event_id FROM E WHERE reasons <> ''",
        "view_counters": f"{QUALITY}, {EVENTS} SELECT CAST(date_trunc('month', ingested_at) AS DATE) AS event_date, {STATUS} AS validation_status, source, "
        "count(*) AS profiles FROM E GROUP BY ALL",
        "retention": f"{QUALITY}, {EVENTS} SELECT 'load ' || CAST(event_id % 2 AS VARCHAR) AS load_id, source, event_id, "
        f"CAST(ingested_at AS DATE) AS day FROM E WHERE reasons <> '' AND {in_period}",
        "retention_on_read": f"{QUALITY}, {EVENTS} SELECT event_id, CAST(ingested_at AS DATE) AS day FROM E WHERE reasons <> '' AND {in_period}",
        "retention_of_counters": f"{QUALITY}, {EVENTS}, M AS (SELECT CAST(date_trunc('month', ingested_at) AS DATE) AS event_date, {STATUS} AS validation_status, source, "
        f"max(CAST(date_trunc('month', ingested_at) AS DATE) + INTERVAL 1 MONTH) AS ended, count(*) AS profiles FROM E GROUP BY 1, 2, 3) "
        f"SELECT event_date, validation_status, source, profiles FROM M WHERE date_diff('day', CAST(ended AS DATE), DATE '{L.RETENTION_TODAY}') < {L.RETENTION_DAYS - 1}",
        "newest_by_user": f"{HOT_EVENTS}, N AS (SELECT *, row_number() OVER (PARTITION BY source, source_user_id, year(ingested_at) ORDER BY ingested_at DESC, event_id DESC) AS rn FROM H) "
        "SELECT source, source_user_id, CAST(year(ingested_at) AS INT) AS year, event_id, username FROM N WHERE rn = 1",
        "stream_counters": "WITH T AS (SELECT CAST(floor(epoch_us(ts) / 21600000000) AS BIGINT) * 21600000000 AS window_us, "
        "CASE WHEN event_type = 'error' THEN 'invalid' ELSE 'valid' END AS validation_status, event_type AS source FROM events) "
        f"SELECT window_us, validation_status, source, count(*) AS profiles FROM T WHERE window_us + 21600000000 <= {WATERMARK} GROUP BY 1, 2, 3",
        "stream_sliding_sli": "WITH T AS (SELECT CAST(floor(epoch_us(ts) / 1800000000) AS BIGINT) * 1800000000 AS slot, event_type FROM events), "
        "W AS (SELECT slot - n * 1800000000 AS window_us, event_type FROM T, (SELECT unnest(range(48)) AS n)) "
        "SELECT CAST(window_us AS BIGINT) AS window_us, count(*) FILTER (WHERE event_type <> 'error') AS good, count(*) AS total, "
        "round(count(*) FILTER (WHERE event_type <> 'error') / count(*), 6) AS success_rate FROM W "
        f"GROUP BY 1 HAVING CAST(window_us AS BIGINT) + 86400000000 <= {WATERMARK}",
        "stream_dedupe": "WITH T AS (SELECT CAST(floor(epoch_us(ts) / 86400000000) AS BIGINT) * 86400000000 AS window_us, *, "
        "row_number() OVER (PARTITION BY user_id, event_type, floor(epoch_us(ts) / 86400000000) ORDER BY ts, event_id) AS rn FROM events) "
        f"SELECT window_us, user_id, event_type, event_id FROM T WHERE rn = 1 AND window_us + 86400000000 <= {WATERMARK}",
        "stream_exactly_once": "SELECT event_id, user_id, event_type FROM events",
        "payload_hashes": "SELECT event_id, CAST(1 AS BIGINT) AS events, true AS same FROM events",
        "stream_late_rows": f"WITH S AS (SELECT event_id, epoch_us(ts) AS us, (SELECT min(epoch_us(ts)) FROM events) AS first FROM events), "
        f"D AS (SELECT event_id, us, least(least(CAST(floor((us - first) / {L.PART_DAYS * 86_400_000_000}) AS INT), {L.PARTS - 1}) "
        f"+ CASE event_id % 10 WHEN 0 THEN 1 WHEN 1 THEN 3 ELSE 0 END, {L.PARTS - 1}) AS batch FROM S), "
        "B AS (SELECT batch, max(max(us)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM D GROUP BY batch) "
        f"SELECT CAST(batch AS BIGINT) AS batch, CASE WHEN us <= (seen // 1000 - {int(L.LATE_DELAY.total_seconds() * 1000)}) * 1000 THEN 'late' ELSE 'on_time' END AS side, "
        "count(*) AS events, CAST(sum(event_id) AS BIGINT) AS ids FROM D JOIN B USING (batch) GROUP BY ALL",
        "stream_route": _stream_route(),
        "stream_recovery": _stream_route(),
        "replay_twice": _stream_route(),
        "stream_progress": "SELECT CAST(120 AS BIGINT) AS batches, count(*) AS input_rows, CAST(0 AS BIGINT) AS late_rows, count(*) AS rows, "
        "count(*) FILTER (WHERE event_type = 'error') AS errors FROM events",
        "latency_sketches": "SELECT event_type, per_mille, count(*) AS rows, true AS within FROM events, (SELECT unnest([500, 950, 990]) AS per_mille) "
        "WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY ALL",
        "contract_by_schema_id": f"WITH {RAW}, I AS (SELECT *, CASE WHEN k % 181 = 1 THEN NULL WHEN k % 11 = 1 THEN 9 WHEN k % 13 = 1 THEN 3 ELSE 1 + k % 2 END AS id FROM RAW) "
        "SELECT k, CAST(id AS BIGINT) AS schema_id, CASE WHEN id IS NULL THEN 'invalid_json' WHEN id = 9 THEN 'unknown_schema' WHEN id = 3 THEN 'wrong_subject' "
        f"WHEN k % 157 BETWEEN 4 AND 10 THEN 'invalid_json' WHEN id = 1 THEN {reasons(wire_pairs())} ELSE {reasons(second_version())} END AS violations FROM I",
        "replay_range": f"WITH {RAW}, G AS (SELECT 'user-' || (k % 1000) AS key, k AS \"offset\", 1704067200 + k * 61 AS sec FROM RAW), "
        f"N AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY sec DESC, \"offset\" DESC) AS rn FROM G WHERE sec >= {start} AND sec < {end}) "
        "SELECT key, sec * 1000000 AS at_us, \"offset\" FROM N WHERE rn = 1",
        "stream_upsert": f"{HOT_EVENTS}, E AS (SELECT *, CAST(date_trunc('month', ingested_at) AS DATE) AS event_date FROM H), "
        "N AS (SELECT *, row_number() OVER (PARTITION BY source, source_user_id, event_date ORDER BY ingested_at DESC, event_id DESC) AS rn FROM E) "
        "SELECT source, source_user_id, event_date, event_id FROM N WHERE rn = 1",
    }

"""Source responses: classification, retry outcome and mapping of nested profiles to flat ones.

A response row holds one attempt of one request. Everything up to the flat profiles is a chain of
narrow projections; only the retry outcome shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilegate import schemas as S
from profilegate.functions import variants as V
from profilegate.functions.barrier import settle

INVALID_PAYLOAD = "invalid_payload"
# A request for less than one profile, which the client refuses to send.
INVALID_REQUEST = "invalid_request"
NO_ATTEMPT = "no_attempt"
RETRYABLE = ("timeout", "http_error", "http_429", "empty_results")

_ITEM = ("gender", "name", "location", "email", "login", "dob", "registered", "phone", "cell", "picture", "nat")
_PARTS = {
    "name": ("title", "first", "last"),
    "location": ("street", "city", "state", "country", "postcode", "coordinates", "timezone"),
    "login": ("uuid", "username"),
    "dob": ("date",),
    "registered": ("date",),
    "picture": ("large", "medium", "thumbnail"),
}
_LOCATION_PARTS = {
    "street": ("number", "name"),
    "coordinates": ("latitude", "longitude"),
    "timezone": ("offset", "description"),
}

# Flat field, where it lives in the source item, and how it is read; in checking order.
_MAPPING = (
    ("country", "location.country", "required"),
    ("source_user_id", "login.uuid", "required"),
    ("gender", "gender", "optional"),
    ("title", "name.title", "optional"),
    ("first_name", "name.first", "required"),
    ("last_name", "name.last", "required"),
    ("street_number", "street.number", "integer"),
    ("street_name", "street.name", "optional"),
    ("city", "location.city", "optional"),
    ("state", "location.state", "optional"),
    ("postcode", "location.postcode", "text_or_integer"),
    ("latitude", "coordinates.latitude", "optional"),
    ("longitude", "coordinates.longitude", "optional"),
    ("timezone_offset", "timezone.offset", "optional"),
    ("timezone_description", "timezone.description", "optional"),
    ("email", "email", "required"),
    ("username", "login.username", "required"),
    ("date_of_birth", "dob.date", "required"),
    ("registered_at", "registered.date", "optional"),
    ("phone", "phone", "optional"),
    ("cell", "cell", "optional"),
    ("picture_large", "picture.large", "optional"),
    ("picture_medium", "picture.medium", "optional"),
    ("picture_thumbnail", "picture.thumbnail", "optional"),
    ("nationality", "nat", "optional"),
)
# Objects in checking order: (name, must be there).
_OBJECTS = (
    ("login", True),
    ("name", True),
    ("location", True),
    ("street", False),
    ("coordinates", False),
    ("timezone", False),
    ("dob", True),
    ("registered", False),
    ("picture", False),
)


def country_code(country: Column) -> Column:
    """ISO code of a source country name, exact match; null for any other name."""
    entries = [F.lit(x) for pair in S.SOURCE_COUNTRY_CODES.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), country)


def _open_item(r: Column) -> Column:
    return V.as_struct(r, *_ITEM)


def _open_parts(u: Column) -> Column:
    """One level down. The raw value of each object stays beside its members, to tell absent from wrong."""
    fields = [u[n].alias(n) for n in _ITEM if n not in _PARTS]
    for part, names in _PARTS.items():
        fields += [u[part].alias(f"{part}_raw"), V.as_struct(u[part], *names).alias(part)]
    return F.struct(u.isNotNull().alias("is_object"), *fields)


def _open_location(p: Column) -> Column:
    location = p["location"]
    kept = [p[n].alias(n) for n in ("is_object", *[n for n in _ITEM if n not in _PARTS])]
    for part in _PARTS:
        kept += [p[f"{part}_raw"].alias(f"{part}_raw"), p[part].alias(part)]
    for part, names in _LOCATION_PARTS.items():
        kept += [location[part].alias(f"{part}_raw"), V.as_struct(location[part], *names).alias(part)]
    return F.struct(*kept)


def _leaf(q: Column, path: str) -> Column:
    head, _, tail = path.partition(".")
    return q[head][tail] if tail else q[head]


def _leaf_error(v: Column, how: str, raw: Column | None) -> Column:
    if how == "required":
        return ~(V.is_string(v) & F.coalesce(V.as_text(v) != "", F.lit(False)))
    if how == "optional":
        return ~(V.absent(v) | V.is_string(v))
    if how == "integer":
        return ~(V.absent(v) | V.is_integer(v))
    # Integers beyond 64 bit and fractions that end in zeros look alike once parsed; the raw text tells.
    whole = V.is_integer(v) & ((V.kind(v) == "BIGINT") | F.coalesce(raw.rlike(r"\A-?[0-9]+\z"), F.lit(True)))
    return ~(V.absent(v) | V.is_string(v) | whole)


def _flatten(q: Column, raw_postcode: Column) -> Column:
    """The flat profile of one source item and the first field that keeps it from being mapped."""
    errors = [F.when(~q["is_object"], F.lit("results"))]
    for name, required in _OBJECTS:
        wrong = q[name].isNull() if required else (q[name].isNull() & ~V.absent(q[f"{name}_raw"]))
        errors.append(F.when(wrong, F.lit(name)))
    values = {"source": F.lit(S.DEMO_SOURCE)}
    for field, path, how in _MAPPING:
        v = _leaf(q, path)
        errors.append(F.when(_leaf_error(v, how, raw_postcode), F.lit(field)))
        values[field] = F.try_variant_get(v, "$", "long") if how == "integer" else V.as_text(v)
    values["country_code"] = country_code(values["country"])
    return F.struct(*[values[n].alias(n) for n in S.NORMALIZED_FIELDS], F.coalesce(*errors).alias("error_field"))


def classify_responses(responses: DataFrame, observe_as: str | None = None) -> DataFrame:
    """Response rows plus ``reason`` (null for success), ``retryable`` and the mapped ``profiles``.

    One bad item fails its whole response, so items are mapped inside the row and never shuffled.
    """
    answered = F.col("transport_error").isNull() & F.col("status_code").between(200, 299)
    df = settle(responses, {"_sealed": F.when(answered, V.sealed(F.col("body")))})
    df = df.withColumn("_root", V.document(F.col("_sealed"), F.col("body"))).drop("_sealed")
    df = df.withColumn("_object", V.as_struct(F.col("_root"), "results"))
    df = df.withColumn("_items", V.as_array(F.col("_object")["results"]))
    opened = F.transform(F.transform(F.transform(F.col("_items"), _open_item), _open_parts), _open_location)
    df = df.withColumn("_opened", opened)

    def flatten(q: Column, i: Column) -> Column:
        path = F.concat(F.lit("$.results["), i.cast("string"), F.lit("].location.postcode"))
        big = V.kind(q["location"]["postcode"]).startswith("DECIMAL")
        raw = F.when(big, F.call_function("get_json_object", F.col("body"), path))
        return _flatten(q, raw)

    df = settle(df, {"profiles": F.transform(F.col("_opened"), flatten)})
    status = F.col("status_code")
    reason = (
        F.when(F.coalesce(F.col("expected_count"), F.lit(0)) < 1, F.lit(INVALID_REQUEST))
        .when(F.col("transport_error") == "timeout", F.lit("timeout"))
        .when(F.col("transport_error").isNotNull(), F.lit("http_error"))
        .when(~F.coalesce(status.between(200, 299), F.lit(False)),
              F.concat(F.lit("http_"), F.coalesce(status.cast("string"), F.lit("error"))))
        .when(F.col("_root").isNull(), F.lit("invalid_json"))
        .when(F.col("_object").isNull() | F.col("_items").isNull(), F.lit("unexpected_response"))
        .when(F.size("_items") == 0, F.lit("empty_results"))
        .when(F.exists("profiles", lambda p: p["error_field"].isNotNull()), F.lit(INVALID_PAYLOAD))
        .when(F.size("_items") != F.col("expected_count"), F.lit("unexpected_response"))
    )
    df = settle(df, {"reason": reason}, observe_as, attempts=F.count(F.lit(1)), failures=F.count("reason"))
    return df.withColumn("retryable", is_retryable(F.col("reason"))).drop("_root", "_object", "_items", "_opened")


def is_retryable(reason: Column) -> Column:
    """Failures worth another attempt; false for success."""
    return F.coalesce(reason.isin(*RETRYABLE) | reason.startswith("http_5"), F.lit(False))


def first_error(classified: DataFrame) -> DataFrame:
    """The first failing field of each response that could not be mapped."""
    failed = F.filter("profiles", lambda p: p["error_field"].isNotNull())
    return classified.filter(F.col("reason") == INVALID_PAYLOAD).withColumn("error_field", F.get(failed, F.lit(0))["error_field"])


def explode_profiles(classified: DataFrame, *carry: str) -> DataFrame:
    """One row per mapped profile of the successful responses, with its correlation columns."""
    ok = classified.filter(F.col("reason").isNull())
    return ok.select(*carry, F.posexplode("profiles").alias("position", "_profile")).select(
        *carry, "position", *[F.col("_profile")[n].alias(n) for n in S.NORMALIZED_FIELDS]
    )


def resolve_attempts(classified: DataFrame, max_retries: int = 2, *carry: str) -> DataFrame:
    """Per request, the attempt that settled it: the first success or final failure, else the last try.

    Attempts after that one are ignored, and so are those without a number or beyond the last retry. A
    request that has no others is reported with the outcome ``no_attempt`` and 0 attempts. Written as one
    aggregation, not a window: each map task folds its attempts before the shuffle, so a request id with a
    flood of copies stays cheap.
    """
    if max_retries < 0:
        raise ValueError("max_retries must not be negative")
    counts = F.coalesce(F.col("attempt").between(0, max_retries), F.lit(False))
    settled = F.struct(
        "attempt", "requested_at", F.coalesce("reason", F.lit("ok")).alias("outcome"), *[F.col(n) for n in carry]
    )
    stops = counts & (F.col("reason").isNull() | ~F.col("retryable"))
    order = F.struct("attempt", "requested_at", F.coalesce("reason", F.lit("ok")))
    merged = classified.groupBy("request_id").agg(
        F.min_by(F.when(stops, settled), F.when(stops, order)).alias("_stop"),
        F.max_by(F.when(counts, settled), F.when(counts, order)).alias("_last"),
    )
    final = F.coalesce("_stop", "_last")
    return merged.select(
        "request_id",
        F.coalesce(final["outcome"], F.lit(NO_ATTEMPT)).alias("outcome"),
        F.coalesce(final["attempt"] + 1, F.lit(0)).alias("attempts_made"),
        *[final[n].alias(n) for n in carry],
    )

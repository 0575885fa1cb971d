"""Semantic quality rules: one ordered list of (reason code, condition) over prepared profiles."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilegate import schemas as S
from profilegate.functions import text as X
from profilegate.functions.barrier import settle

REASONS = "rejection_reasons"
SEPARATOR = ","

# Parsed companions of text columns, added by prepare() and dropped by finish().
BIRTH, REGISTERED, LATITUDE, LONGITUDE, DIRTY = "_birth", "_registered", "_latitude", "_longitude", "_dirty"
PARSED = (BIRTH, REGISTERED, LATITUDE, LONGITUDE, DIRTY)


class Rule(NamedTuple):
    """A reason code and the condition under which a row earns it. A null condition means no."""

    code: str
    condition: Column


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def prepare(df: DataFrame) -> DataFrame:
    """Strip every text field and parse dates and coordinates once, for all rules to share.

    Missing profile columns are added as nulls, so narrower tables can be checked as well.
    Text that did not parse leaves a null companion next to a non-null text column.
    """
    missing = [n for n in S.PROFILE_FIELDS if n not in df.columns]
    if missing:
        defaults = {"schema_version": S.SCHEMA_VERSION, "event_type": S.USER_CREATED_TYPE}
        types = {f.name: f.dataType for f in S.NORMALIZED_SCHEMA}
        df = df.withColumns({n: F.lit(defaults.get(n)).cast(types.get(n, T.StringType())) for n in missing})
    stripped = {n: X.strip(n) for n in S.PROFILE_FIELDS if is_text(df, n)}
    for name, default in (("schema_version", S.SCHEMA_VERSION), ("event_type", S.USER_CREATED_TYPE)):
        stripped[name] = F.coalesce(stripped[name], F.lit(default))
    df = df.withColumns(stripped)

    def instant(name: str) -> Column:
        return X.parse_timestamp(F.col(name)) if is_text(df, name) else F.col(name).cast("timestamp")

    def number(name: str) -> Column:
        return X.parse_number(F.col(name)) if is_text(df, name) else F.col(name).cast("double")

    texts = [F.col(n) for n in S.TEXT_FIELDS if is_text(df, n)]
    return df.withColumns(
        {
            BIRTH: instant("date_of_birth"),
            REGISTERED: instant("registered_at"),
            LATITUDE: number("latitude"),
            LONGITUDE: number("longitude"),
            # One scan over the whole row settles the control-character rules of clean rows.
            DIRTY: X.has_control(F.concat_ws("", *texts)),
            "email": X.lower_domain(F.col("email")),
        }
    )


def finish(df: DataFrame) -> DataFrame:
    return df.drop(*PARSED)


def quality_rules(df: DataFrame, today: dt.date | Column, country_codes: Sequence[str] | None = None) -> list[Rule]:
    """The built-in rules in reporting order, for a frame that went through prepare()."""
    c = F.col
    codes = country_codes or S.iso_country_codes()
    rules = [
        Rule("missing_source", X.is_blank(c("source"))),
        Rule("missing_source_user_id", X.is_blank(c("source_user_id"))),
        Rule("missing_email", X.is_blank(c("email"))),
        Rule("missing_username", X.is_blank(c("username"))),
        Rule("missing_country", X.is_blank(c("country"))),
        Rule(
            "unsupported_country",
            (c("source") == S.DEMO_SOURCE)
            & ~X.is_blank(c("country"))
            & ~X.one_of("country", S.SOURCE_COUNTRY_CODES),
        ),
        Rule("invalid_country_code", ~X.one_of("country_code", codes)),
    ]

    given = ~X.is_blank(c("date_of_birth")) if is_text(df, "date_of_birth") else c(BIRTH).isNotNull()
    age = X.age_on(c(BIRTH), today)
    rules += [
        Rule("missing_date_of_birth", ~given),
        Rule("invalid_date_of_birth", given & c(BIRTH).isNull()),
        Rule("implausible_age", ~age.between(S.MIN_AGE, S.MAX_AGE)),
        Rule("invalid_registered_at", c("registered_at").isNotNull() & c(REGISTERED).isNull()),
        Rule("registered_before_date_of_birth", c(REGISTERED) < c(BIRTH)),
        Rule("registered_in_future", F.to_date(c(REGISTERED)) > X.as_day(today)),
        Rule("invalid_latitude", c("latitude").isNotNull() & ~X.in_bounds(c(LATITUDE), -90.0, 90.0)),
        Rule("invalid_longitude", c("longitude").isNotNull() & ~X.in_bounds(c(LONGITUDE), -180.0, 180.0)),
        Rule("invalid_nationality", ~X.one_of("nationality", codes)),
        Rule("invalid_timezone_offset", ~X.valid_utc_offset(c("timezone_offset"))),
    ]
    rules += [
        Rule(f"invalid_picture_url:{name}", ~X.valid_https_url(c(name), S.MAX_URL_LENGTH)) for name in S.PICTURE_FIELDS
    ]
    for name in S.TEXT_FIELDS:
        if is_text(df, name):
            rules += text_rules(name, S.MAX_URL_LENGTH if name in S.PICTURE_FIELDS else S.MAX_TEXT_LENGTH, c(DIRTY))
    return rules


def text_rules(name: str, max_length: int, maybe_dirty: Column | None = None) -> list[Rule]:
    """Length and control-character rules for one text column."""
    dirty = X.has_control(F.col(name))
    return [
        Rule(f"text_field_too_long:{name}", X.longer_than(name, max_length)),
        Rule(f"text_field_has_control_characters:{name}", dirty if maybe_dirty is None else maybe_dirty & dirty),
    ]


def insert_after(rules: Iterable[Rule], code: str, *extra: Rule) -> list[Rule]:
    """The same rules with more of them placed right after a given code."""
    out: list[Rule] = []
    for rule in rules:
        out.append(rule)
        if rule.code == code:
            out.extend(extra)
    if not any(rule.code == code for rule in out):
        raise ValueError(f"no rule named {code!r}")
    return out


def joined_codes(rules: Sequence[Rule]) -> Column:
    """All codes that apply as one text, in rule order, each once.

    The codes are joined, and split later, rather than filtered out of an array: concat_ws and
    split stay inside generated code, array filters do not.
    """
    conditions: dict[str, Column] = {}
    for code, condition in rules:
        if SEPARATOR in code or not code:
            raise ValueError(f"a reason code must be non-empty and free of commas: {code!r}")
        conditions[code] = conditions[code] | condition if code in conditions else condition
    return F.concat_ws(SEPARATOR, *[F.when(condition, F.lit(code)) for code, condition in conditions.items()])


def split_codes(joined: Column) -> Column:
    none = F.array_remove(F.array(F.lit("")), "")  # an empty array without null elements
    return F.when(joined == "", none).otherwise(F.split(joined, SEPARATOR))


def with_reasons(df: DataFrame, rules: Sequence[Rule], column: str = REASONS, observe_as: str | None = None) -> DataFrame:
    """Adds the ordered reason codes of each row, and observes how many rows earned any."""
    marked = settle(
        df,
        {"_codes": joined_codes(rules)},
        observe_as,
        rows=F.count(F.lit(1)),
        with_reasons=F.count_if(F.col("_codes") != ""),
    )
    return marked.withColumn(column, split_codes(F.col("_codes"))).drop("_codes")


def check_quality(
    df: DataFrame,
    today: dt.date | Column,
    *,
    country_codes: Sequence[str] | None = None,
    extra_rules: Sequence[Rule] = (),
    observe_as: str | None = None,
) -> DataFrame:
    """Profiles plus their ordered rejection reasons. Narrow: no shuffle, no Python."""
    prepared = prepare(df)
    rules = [*quality_rules(prepared, today, country_codes), *extra_rules]
    return finish(with_reasons(prepared, rules, observe_as=observe_as))


def is_valid(reasons: Column | str = REASONS) -> Column:
    return F.size(reasons) == 0


def with_status(df: DataFrame, today: dt.date | Column) -> DataFrame:
    """Quality metadata next to the reasons: status, number of reasons and age."""
    return df.withColumns(
        {
            "validation_status": F.when(is_valid(), F.lit("valid")).otherwise(F.lit("invalid")),
            "reason_count": F.size(REASONS),
            "age_years": X.age_on(
                X.parse_timestamp(F.col("date_of_birth"))
                if is_text(df, "date_of_birth")
                else F.col("date_of_birth").cast("timestamp"),
                today,
            ),
        }
    )


def enrich(df: DataFrame, today: dt.date | Column, ingested_at: Column | None = None) -> DataFrame:
    """with_status() plus when the row was ingested, if known, and when it is being processed."""
    times = {"processed_at": F.current_timestamp()}
    if ingested_at is not None:
        times["ingested_at"] = ingested_at.cast("timestamp")
    return with_status(df, today).withColumns(times)

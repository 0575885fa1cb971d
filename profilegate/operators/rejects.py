"""Privacy-reduced events for rejected profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilegate import schemas as S
from profilegate.functions.privacy import pseudonym
from profilegate.operators import rules as R


def redacted_payload() -> Column:
    """The allow-listed fields only; the payload keeps the event type of the rejected profile."""
    return F.struct(*[F.col(n) for n in S.PAYLOAD_FIELDS])


def pseudonym_of_row(salt: str | None) -> Column:
    return pseudonym(F.col("source"), F.col("source_user_id"), salt)


def invalid_event_columns(user: Column) -> list[Column]:
    """The fields of an invalid event, given the pseudonym of its user."""
    return [
        F.lit(S.SCHEMA_VERSION).alias("schema_version"),
        F.lit(S.USER_PROFILE_INVALID_TYPE).alias("event_type"),
        F.col("source"),
        user.alias("source_user_id"),
        F.col(R.REASONS).alias("rejection_reasons"),
        redacted_payload().alias("payload"),
    ]


def invalid_events(checked: DataFrame, salt: str | None, *carry: str) -> DataFrame:
    """One invalid event per rejected row. ``carry`` keeps non-personal columns such as event time."""
    rejected = checked.filter(~R.is_valid())
    return rejected.select(*carry, *invalid_event_columns(pseudonym_of_row(salt)))


def valid_events(checked: DataFrame, *carry: str) -> DataFrame:
    return checked.filter(R.is_valid()).select(*carry, *S.PROFILE_FIELDS)

"""Column helpers for text, dates, coordinates, e-mail and URL checks. All stay on the JVM."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters with the Unicode White_Space property; fixed values.
WHITE_SPACE = "".join(
    map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
# The blank test also treats the four information separators as space.
BLANK_SPACE = WHITE_SPACE + "\x1c\x1d\x1e\x1f"

CONTROL = r"\p{Cc}"

# Calendar date, optionally with a time of day, a fraction and an offset.
DATE_TIME = (
    r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"(?:[Tt _][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:[.][0-9]{1,9})?)?(?:[Zz]|[+-][0-9]{2}:?[0-9]{2})?)?\z"
)
NUMBER = r"\A[+-]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]+)?\z"
# Optional sign (plus when missing), one or two hour digits, minutes; from -12:00 to +14:00.
UTC_OFFSET = (
    r"\A(?:[+]?(?:0?[0-9]|1[0-3]):[0-5][0-9]|[+]?14:00"
    r"|-(?:0?[0-9]|1[01]):[0-5][0-9]|-12:00)\z"
)

_ATOM = r"[A-Za-z0-9_!#$%&'*+/=?^`{|}~\p{L}\p{N}\p{M}-]+"
_LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?"
EMAIL = rf"\A{_ATOM}(?:[.]{_ATOM})*@(?:{_LABEL}[.])+(?:[A-Za-z0-9][A-Za-z0-9-]{{0,61}})?[A-Za-z]\z"
# Top-level names reserved by RFC 6761 and RFC 7686, which no mail can reach.
RESERVED_DOMAIN = r"[.@](?:arpa|invalid|local|localhost|onion|test)\z"

# Up to 65535, or none after the colon.
_PORT = r"(?:[0-9]{0,4}|[0-5][0-9]{4}|6(?:[0-4][0-9]{3}|5(?:[0-4][0-9]{2}|5(?:[0-2][0-9]|3[0-5]))))"
HTTP_URL = (
    r"(?is)\Ahttps?://(?:[^/?#@\s]*@)?"
    r"(?:\[[0-9a-f:.]+\]|[^\s/?#@:\[\]<>^|%\\\"{}`]+)(?::" + _PORT + r")?(?:[/?#\\].*)?\z"
)
HTTPS_WITH_HOST = r"(?i)\Ahttps://[^/?#]"


def _visible(c: Column) -> Column:
    """Starts with a visible ASCII character; two byte comparisons."""
    return (c >= "!") & (c < "\x7f")


def strip(name: str) -> Column:
    """Trim Unicode white space from both ends of a column.

    Most values start and end with a visible ASCII character and stay as they are; only the others
    pay for the set-based trim. SQL text, because it is built once per field of a profile and each
    Column call is a round trip to the JVM.
    """
    last = f"substring(`{name}`, -1, 1)"
    visible = f"`{name}` >= '!' AND `{name}` < '\x7f' AND {last} >= '!' AND {last} < '\x7f'"
    return F.expr(f"CASE WHEN {visible} THEN `{name}` ELSE btrim(`{name}`, '{WHITE_SPACE}') END")


def is_blank(c: Column) -> Column:
    """True for null and for text made of white space only."""
    return c.isNull() | (~_visible(c) & (F.btrim(c, F.lit(BLANK_SPACE)) == ""))


def has_control(c: Column) -> Column:
    return c.rlike(CONTROL)


def parse_timestamp(c: Column) -> Column:
    """ISO text to an instant, null where it is no date or date-time; no offset means UTC.

    The shape is checked first: a bare cast would take ``12:30`` for today and ``2000`` for a year.
    """
    text = F.upper(F.translate(c, "_", " "))
    text = F.regexp_replace(text, r"([+-][0-9]{2})([0-9]{2})\z", "$1:$2")
    return F.when(c.rlike(DATE_TIME) & ~c.startswith("0000"), text.try_cast("timestamp"))


def parse_number(c: Column) -> Column:
    """Decimal text to double; null for anything else, also for Java spellings such as ``1d``."""
    return F.when(c.rlike(NUMBER), c.try_cast("double"))


def in_bounds(number: Column, low: float, high: float) -> Column:
    """False for null and NaN, so a value that did not parse counts as out of bounds."""
    return F.coalesce(number.between(low, high) & ~F.isnan(number), F.lit(False))


def valid_email(c: Column) -> Column:
    at = F.instr(c, "@")
    return (
        c.rlike(EMAIL)
        & (F.length(c) <= 254)
        & (at <= 65)
        & ~F.lower(c).rlike(RESERVED_DOMAIN)
    )


def lower_domain(c: Column) -> Column:
    domain = F.substring_index(c, "@", -1)
    return F.when(c.contains("@"), F.concat(F.substring_index(c, "@", 1), F.lit("@"), F.lower(domain))).otherwise(c)


def valid_http_url(c: Column) -> Column:
    return c.rlike(HTTP_URL)


def valid_https_url(c: Column, max_length: int) -> Column:
    return c.rlike(HTTPS_WITH_HOST) & (F.length(c) <= max_length) & ~has_control(c)


def valid_utc_offset(c: Column) -> Column:
    """``[+-]H:MM`` between -12:00 and +14:00, the bounds being part of the pattern."""
    return c.rlike(UTC_OFFSET)


def longer_than(name: str, limit: int) -> Column:
    """More than ``limit`` characters. The byte count is known, so short text is not scanned."""
    return F.expr(f"octet_length(`{name}`) > {limit} AND length(`{name}`) > {limit}")


def one_of(name: str, values: Iterable[str]) -> Column:
    """Membership in a fixed set, which Spark turns into a hash lookup."""
    listed = ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)
    return F.expr(f"`{name}` IN ({listed})")


def as_day(today: dt.date | Column) -> Column:
    return F.lit(today) if isinstance(today, dt.date) else today


def age_on(birth: Column, today: dt.date | Column) -> Column:
    """Whole years lived on ``today``; a 29 February birthday counts from 1 March in other years."""
    day = as_day(today)
    month_day = lambda c: F.month(c) * 100 + F.dayofmonth(c)
    return F.year(day) - F.year(birth) - (month_day(day) < month_day(birth)).cast("int")


def iso_utc(ts: Column) -> Column:
    """Instant to ISO text with ``Z``; a fraction appears only when it is not zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.unix_micros(ts)
    fraction = F.when(F.pmod(micros, F.lit(1_000_000)) != 0, F.date_format(ts, ".SSSSSS")).otherwise("")
    return F.concat(whole, fraction, F.lit("Z"))

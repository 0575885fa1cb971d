"""Strict JSON typing on VARIANT columns: a value keeps its JSON kind and is never coerced."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def kind(v: Column) -> Column:
    """JSON kind of a value: null when absent, VOID for a JSON null."""
    return F.schema_of_variant(v)


def absent(v: Column) -> Column:
    return v.isNull() | F.is_variant_null(v)


def as_struct(v: Column, *names: str) -> Column:
    """The named members of a JSON object, each still a variant; null when it is not an object."""
    members = ", ".join(f"`{n}`: variant" for n in names)
    return F.try_variant_get(v, "$", f"struct<{members}>")


def as_array(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def is_string(v: Column) -> Column:
    return F.coalesce(kind(v) == "STRING", F.lit(False))


def as_text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def is_integer(v: Column) -> Column:
    """A JSON integer of any size. Small ones are BIGINT, those beyond 64 bit show as DECIMAL(p,0)."""
    k = kind(v)
    return F.coalesce((k == "BIGINT") | k.rlike(r"\ADECIMAL\((?:19|[23][0-9]),0\)\z"), F.lit(False))


def number_kind(k: Column) -> Column:
    return (k == "BIGINT") | k.startswith("DECIMAL") | k.isin("DOUBLE", "FLOAT")


def whole_number(text: Column) -> Column:
    """The number of a JSON number's text as a long, without a detour through double.

    A fraction of zeros counts as whole. Null for other fractions and for what a long can't hold.
    """
    digits = F.regexp_replace(text, r"\.0+\z", "").try_cast("long")
    power = text.try_cast("double")
    return F.coalesce(digits, F.when(text.contains("E") & (power == F.floor(power)), power.try_cast("long")))


def sealed(value: Column) -> Column:
    """JSON text parsed as the first of two elements, the second being the hash of the text.

    Parsers stop at the end of the first document and ignore what follows, and text can close a bracket put
    around it, but no text can contain the hash of itself. ``document()`` tells what came of it; the two are
    apart so that the parse can be computed once.
    """
    return F.from_json(F.concat(F.lit("["), value, F.lit(',"'), F.sha2(value, 256), F.lit('"]')), "array<variant>")


def document(parsed: Column, value: Column) -> Column:
    """The document of sealed text; null unless the text is exactly one."""
    whole = (F.size(parsed) == 2) & (as_text(F.get(parsed, F.lit(1))) == F.sha2(value, 256))
    return F.when(whole, F.get(parsed, F.lit(0)))


def _plain_number(text: Column) -> Column:
    """One spelling for all of a JSON number's: digits without exponent, without a fraction's trailing zeros, no minus zero.

    Exponents are written out within 38 digits, 18 of them behind the point; beyond, a number keeps its spelling.
    """
    whole = text.try_cast("double") == F.floor(text.try_cast("double"))
    digits = F.coalesce(F.when(whole, text.try_cast("decimal(38,0)").cast("string")), text.try_cast("decimal(38,18)").cast("string"), text)
    plain = F.when(text.rlike("[eE]"), digits).otherwise(text)
    plain = F.regexp_replace(F.regexp_replace(plain, r"\A(-?[0-9]+\.[0-9]*?)0+\z", "$1"), r"\.\z", "")
    return F.when(plain == "-0", F.lit("0")).otherwise(plain)


# JSON text of a variant has its keys in order and no spaces. What can still be spelled in two ways there: numbers with an
# exponent, with zeros at the end of their fraction or minus zero; and keys beyond the basic plane, which have two orders.
_UNSETTLED = r"[0-9]E|\.[0-9]*0(?![0-9])|-0(?![0-9.])|[\x{10000}-\x{10FFFF}]"


def canonical(v: Column, depth: int = 6) -> Column:
    """JSON text of a variant that doesn't depend on the order of keys or on how numbers are spelled.

    Text in which nothing is left to settle is taken as it is; else objects and arrays are taken apart down to ``depth``
    levels, at many times the cost and with the same outcome. What lies deeper has its keys in order, and its numbers as they
    were. Null for an absent value.
    """
    # Bound by a transform, so that the text is made once.
    texts = F.transform(F.array(F.to_json(v)), lambda text: F.when(text.rlike(_UNSETTLED), _settled(v, depth)).otherwise(text))
    return texts[0]


def _settled(v: Column, depth: int) -> Column:
    def of_bound(x: Column) -> Column:
        value, k = x["value"], x["kind"]
        text = F.to_json(value)
        leaf = F.when(number_kind(k), _plain_number(text)).otherwise(text)
        if depth == 0:
            return leaf
        by_key = lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)
        members = F.array_sort(F.map_entries(F.try_variant_get(value, "$", "map<string, variant>")), by_key)
        # to_json quotes no bare text: the key is taken out of {"k":...}.
        quoted = lambda e: F.regexp_extract(F.to_json(F.struct(e["key"].alias("k"))), r"(?s)\A.{5}(.*).\z", 1)
        # A null member is a null variant, never a missing one.
        both = F.when(k.startswith("OBJECT<"), F.transform(members, lambda e: F.struct(F.concat(quoted(e), F.lit(":")).alias("label"), e["value"].alias("value"))))
        both = both.otherwise(F.transform(as_array(value), lambda e: F.struct(F.lit("").alias("label"), e.alias("value"))))
        inner = F.array_join(F.transform(both, lambda e: F.concat(e["label"], _settled(e["value"], depth - 1))), ",")
        whole = F.concat(F.when(k.startswith("OBJECT<"), F.lit("{")).otherwise(F.lit("[")), inner, F.when(k.startswith("OBJECT<"), F.lit("}")).otherwise(F.lit("]")))
        return F.when(k.startswith("OBJECT<") | k.startswith("ARRAY<"), whole).otherwise(leaf)

    # Bound by a transform, so that a parse or a member is computed once however often it is used.
    bound = F.transform(F.array(v), lambda x: F.struct(x.alias("value"), kind(x).alias("kind")))
    return F.transform(bound, of_bound)[0]


def payload_hash(json: Column, depth: int = 6) -> Column:
    """A digest of what a JSON text says; of the text itself where it is no JSON. Null for a null text."""
    parsed = F.try_parse_json(json)
    return F.sha2(F.coalesce(canonical(parsed, depth), json).cast("binary"), 256)

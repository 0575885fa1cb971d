"""Contracts by schema id: JSON Schema documents compiled to Column checks, chosen for each message by the id it is framed with.

A registry is a small table, one row per schema id with subject, version and the document. Documents may use the keywords
listed in ``KEYWORDS`` and ``NOTES``; any other is refused, since a keyword that is passed over lets bad messages through.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from profilegate.functions import variants as V
from profilegate.functions.barrier import settle
from profilegate.operators import contract as C
from profilegate.operators import routing as RT
from profilegate.operators import rules as R

UNKNOWN_SCHEMA, WRONG_SUBJECT = "unknown_schema", "wrong_subject"
MOST_CONTRACTS = 1000
COLUMNS = "schema_id long, subject string, version int, schema string"

DOCUMENT_KEYWORDS = {"type", "properties", "required", "additionalProperties"}
KEYWORDS = {"type", "const", "enum", "minLength", "maxLength", "pattern", "format", "minimum", "maximum", "items", "minItems"}
NOTES = {"$schema", "$id", "$comment", "title", "description", "default", "examples"}
TYPES = {"string", "integer", "number", "boolean", "object", "array", "null"}
FORMATS = {"email", "date-time", "uri"}


@dataclass(frozen=True)
class Contract:
    schema_id: int
    subject: str
    version: int
    document: Mapping

    def __post_init__(self) -> None:
        check_document(self.document)

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(self.document.get("properties", {}))


def _types(schema: Mapping) -> set[str]:
    given = schema.get("type", sorted(TYPES))
    return {given} if isinstance(given, str) else set(given)


def _refuse(where: str, unknown: set) -> None:
    if unknown:
        raise ValueError(f"{where}: not supported: {', '.join(sorted(map(str, unknown)))}")


def check_document(document: Mapping) -> None:
    """Refuse what the compiler would not honour."""
    _refuse("document", set(document) - DOCUMENT_KEYWORDS - NOTES)
    _refuse("document", _types(document) - {"object"} if "type" in document else set())
    if not isinstance(document.get("additionalProperties", True), bool):
        raise ValueError("additionalProperties must be true or false")
    _refuse("required without property", set(document.get("required", ())) - set(document.get("properties", {})))
    for name, schema in document.get("properties", {}).items():
        _refuse(name, set(schema) - KEYWORDS - NOTES)
        _refuse(name, _types(schema) - TYPES)
        _refuse(name, {schema["format"]} - FORMATS if "format" in schema else set())
        for value in [*schema.get("enum", ()), *([schema["const"]] if "const" in schema else [])]:
            if not isinstance(value, str | int | float | bool | None):
                raise ValueError(f"{name}: const and enum must be plain values")
        if "items" in schema:
            _refuse(f"{name} items", set(schema["items"]) - {"type", "minLength"} - NOTES)
            _refuse(f"{name} items", _types(schema["items"]) - {"string"})


def _equals(value, kind: Column, text: Column) -> Column:
    if value is None:
        return kind == "VOID"
    if isinstance(value, bool):
        return (kind == "BOOLEAN") & (text == str(value).lower())
    if isinstance(value, str):
        return (kind == "STRING") & (text == value)
    return V.number_kind(kind) & (text.try_cast("double") == F.lit(float(value)))


def _has_type(name: str, kind: Column, text: Column) -> Column:
    return {
        "string": lambda: kind == "STRING",
        "null": lambda: kind == "VOID",
        "boolean": lambda: kind == "BOOLEAN",
        "number": lambda: V.number_kind(kind),
        "integer": lambda: V.number_kind(kind) & V.whole_number(text).isNotNull(),
        "object": lambda: kind.startswith("OBJECT<"),
        "array": lambda: kind.startswith("ARRAY<"),
    }[name]()


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for condition in conditions:
        out |= condition
    return out


def conforms(schema: Mapping, kind: Column, text: Column) -> Column:
    """Whether a value that is present satisfies its schema; a constraint on one type leaves values of others alone."""
    checks = [_any([_has_type(t, kind, text) for t in sorted(_types(schema))])] if "type" in schema else []
    if "const" in schema:
        checks.append(_equals(schema["const"], kind, text))
    if "enum" in schema:
        checks.append(_any([_equals(v, kind, text) for v in schema["enum"]]))
    is_text, is_number, is_array = kind == "STRING", V.number_kind(kind), kind.startswith("ARRAY<")
    if "minLength" in schema:
        checks.append(~is_text | (F.length(text) >= schema["minLength"]))
    if "maxLength" in schema:
        checks.append(~is_text | (F.length(text) <= schema["maxLength"]))
    if "pattern" in schema:
        checks.append(~is_text | F.regexp_like(text, F.lit(schema["pattern"].replace("$", r"\z"))))
    if "format" in schema:
        checks.append(~is_text | C._format_ok(schema["format"], text))
    if "minimum" in schema:
        checks.append(~is_number | (text.try_cast("double") >= schema["minimum"]))
    if "maximum" in schema:
        checks.append(~is_number | (text.try_cast("double") <= schema["maximum"]))
    items = F.from_json(F.when(is_array, text), "array<variant>")
    if "minItems" in schema:
        checks.append(~is_array | (F.size(items) >= schema["minItems"]))
    if "items" in schema:
        least = schema["items"].get("minLength", 0)
        checks.append(~is_array | F.forall(items, lambda x: V.is_string(x) & (F.length(V.as_text(x)) >= least)))
    out = F.lit(True)
    for check in checks:
        out &= F.coalesce(check, F.lit(False))
    return out


def violations(contract: Contract, kinds: Column, texts: Column, keys: Column) -> Column:
    """Codes of all the ways a parsed message breaks a contract, joined."""
    document = contract.document
    rules = []
    if not document.get("additionalProperties", True):
        names = F.array(*[F.lit(n) for n in contract.names]).cast("array<string>")
        rules.append(R.Rule(C.UNKNOWN_FIELDS, F.size(F.array_except(keys, names)) > 0))
    for name, schema in document.get("properties", {}).items():
        kind = kinds[name]
        broken = ~conforms(schema, kind, texts[name])
        absent = F.lit(name in document.get("required", ()))
        rules.append(R.Rule(C.VIOLATION + name, F.when(kind.isNull(), absent).otherwise(broken)))
    return R.joined_codes(rules)


def read_registry(spark: SparkSession, path: str) -> dict[int, Contract]:
    """Contracts by schema id from a Parquet table of ``COLUMNS``."""
    rows = spark.read.schema(COLUMNS).parquet(path).limit(MOST_CONTRACTS + 1).collect()
    if len(rows) > MOST_CONTRACTS:
        raise ValueError(f"{path} holds more than {MOST_CONTRACTS} contracts; a job is told those it may meet")
    out = {r["schema_id"]: Contract(r["schema_id"], r["subject"], r["version"], json.loads(r["schema"])) for r in rows}
    if len(out) < len(rows):
        raise ValueError("a schema id names one document")
    return out


def check_framed(df: DataFrame, registry: Mapping[int, Contract], *, topic: str = "topic", value: str = "value", column: str = "violations") -> DataFrame:
    """Framed messages plus the ways each breaks the contract its schema id names, empty when it conforms.

    An id nobody registered reports ``unknown_schema``, one of another subject than the topic's ``wrong_subject``, and bytes that
    are not framed or hold no JSON object ``invalid_json``. Works on streams and tables, in one narrow stage.
    """
    names = list(dict.fromkeys(n for contract in registry.values() for n in contract.names))
    df = C.parse_messages(RT.unframe(df, value), "json", names, "_message")
    root, schema_id = F.col("_message"), F.col("schema_id")
    codes = F.when(schema_id.isNull(), F.lit(C.INVALID_JSON))
    codes = codes.when(~schema_id.isin(list(registry)), F.lit(UNKNOWN_SCHEMA))
    for contract in registry.values():
        codes = codes.when((schema_id == contract.schema_id) & ~C.subject(topic).eqNullSafe(F.lit(contract.subject)), F.lit(WRONG_SUBJECT))
    codes = codes.when(root.isNull(), F.lit(C.INVALID_JSON))
    for contract in registry.values():
        codes = codes.when(schema_id == contract.schema_id, violations(contract, root["kinds"], root["texts"], root["keys"]))
    out = settle(df, {"_codes": codes})
    return out.withColumn(column, R.split_codes(F.col("_codes"))).drop("_codes", "_message")


def incompatibilities(old: Mapping, new: Mapping) -> list[str]:
    """Why a reader of ``new`` could meet messages of ``old`` that it refuses; empty if it is backward compatible.

    Told from the documents alone: what was allowed must still be allowed.
    """
    check_document(old)
    check_document(new)
    before, after = old.get("properties", {}), new.get("properties", {})
    closed_before, closed_after = (not d.get("additionalProperties", True) for d in (old, new))
    out = [f"{n}: newly required" for n in new.get("required", ()) if n not in old.get("required", ())]
    if closed_after:
        out += [f"{n}: no longer allowed" for n in before if n not in after]
        out += [] if closed_before else ["other fields: no longer allowed"]
    if not closed_before:
        out += [f"{n}: was free before" for n in after if n not in before and set(after[n]) & KEYWORDS]
    for name in [n for n in before if n in after]:
        was, now = before[name], after[name]
        values = lambda s: [*s.get("enum", ()), *([s["const"]] if "const" in s else [])]
        if "type" in now and not values(was):
            widened = _types(now) | ({"integer"} if "number" in _types(now) else set())
            out += [f"{name}: type {t} no longer allowed" for t in sorted(_types(was) - widened)]
        if values(now) and not (values(was) and all(v in values(now) for v in values(was))):
            out.append(f"{name}: fewer values allowed")
        for word in ("minLength", "minItems", "minimum"):
            if word in now and not (word in was and was[word] >= now[word]):
                out.append(f"{name}: {word} is stricter")
        for word in ("maxLength", "maximum"):
            if word in now and not (word in was and was[word] <= now[word]):
                out.append(f"{name}: {word} is stricter")
        for word in ("pattern", "format", "items"):
            if word in now and was.get(word) != now[word]:
                out.append(f"{name}: {word} differs")
    return sorted(out)

"""Structural checks: mapped profiles against the event model, messages against the topic contract."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilegate import schemas as S
from profilegate.functions import text as X
from profilegate.functions import variants as V
from profilegate.functions.barrier import settle
from profilegate.operators import rules as R

VIOLATION = "contract_violation:"
NO_CONTRACT = "no_contract"
INVALID_JSON = "invalid_json"
UNKNOWN_FIELDS = VIOLATION + "additional_properties"

COMPATIBILITY = "BACKWARD"


# --- mapped profiles (all text) ---------------------------------------------------------------


def structural_rules(df: DataFrame) -> list[R.Rule]:
    """What the event model refuses, under the declared reason code where there is one.

    For a frame that went through rules.prepare(). The model's other refusals (blank ids, bad dates,
    coordinates out of bounds, country codes that are not two letters) have the condition and the
    code of a semantic rule already.
    """
    c = F.col
    fixed = (("schema_version", S.SCHEMA_VERSION), ("event_type", S.USER_CREATED_TYPE))
    rules = [R.Rule(VIOLATION + name, c(name) != value) for name, value in fixed]
    rules += [R.Rule(VIOLATION + n, F.coalesce(c(n), F.lit("")) == "") for n in ("first_name", "last_name")]
    if R.is_text(df, "street_number"):
        number = c("street_number")
        rules.append(R.Rule(VIOLATION + "street_number", number.isNotNull() & number.try_cast("long").isNull()))
    return rules


def email_rule() -> R.Rule:
    return R.Rule("invalid_email", ~X.is_blank(F.col("email")) & ~X.valid_email(F.col("email")))


def url_rules() -> list[R.Rule]:
    return [R.Rule(f"invalid_picture_url:{n}", ~X.valid_http_url(F.col(n))) for n in S.PICTURE_FIELDS]


def check_profiles(
    df: DataFrame,
    today: dt.date | Column,
    *,
    country_codes: Sequence[str] | None = None,
    extra_rules: Sequence[R.Rule] = (),
    typed: bool = True,
    observe_as: str | None = None,
) -> DataFrame:
    """Structural and semantic checks in one narrow stage.

    Reasons come structural first, then in rule order. With ``typed`` the event columns get their
    contract types; values that did not parse become null, and their row carries the reason.
    """
    prepared = R.prepare(df)
    quality = R.insert_after(R.quality_rules(prepared, today, country_codes), "missing_email", email_rule())
    rules = [*structural_rules(prepared), *quality, *url_rules(), *extra_rules]
    checked = R.with_reasons(prepared, rules, observe_as=observe_as)
    return R.finish(as_typed(checked) if typed else checked)


def as_typed(prepared: DataFrame) -> DataFrame:
    """Swap parsed companions in for their text columns."""
    return prepared.withColumns(
        {
            "date_of_birth": F.col(R.BIRTH),
            "registered_at": F.col(R.REGISTERED),
            "latitude": F.col(R.LATITUDE),
            "longitude": F.col(R.LONGITUDE),
            "street_number": F.col("street_number").try_cast("long"),
        }
    )


# --- messages on a topic ----------------------------------------------------------------------


def subject(topic: Column | str) -> Column:
    return F.concat(F.col(topic) if isinstance(topic, str) else topic, F.lit("-value"))


def contracts(
    created_topic: str = S.CREATED_TOPIC, invalid_topic: str = S.INVALID_TOPIC, valid_topic: str | None = None
) -> dict[str, tuple[S.Field, ...]]:
    """Topic name to field contract; topics may be renamed, their contracts follow.

    The valid stream carries created events, so its contract is theirs.
    """
    out = {created_topic: S.USER_CREATED_FIELDS, invalid_topic: S.USER_PROFILE_INVALID_FIELDS}
    return out if valid_topic is None else out | {valid_topic: S.USER_CREATED_FIELDS}


def json_schema(title: str, fields: Sequence[S.Field]) -> dict:
    """The contract as a JSON Schema (2020-12) document."""
    return {
        "$schema": "https://json-schema.org/draft/2020-12/schema",
        "title": title,
        "type": "object",
        "additionalProperties": False,
        "required": [f.name for f in fields if f.required],
        "properties": {f.name: _property(f) for f in fields},
    }


def _property(f: S.Field) -> dict:
    if f.const is not None:
        return {"const": f.const}
    if f.kind == "object":
        return {"type": "object"}
    if f.kind == "reasons":
        return {"type": "array", "minItems": 1, "items": {"type": "string", "minLength": 1}}
    out: dict = {"type": f.kind if f.required else [f.kind, "null"]}
    if f.required and f.fmt is None:
        out["minLength"] = 1
    if f.exact_length is not None:
        out |= {"minLength": f.exact_length, "maxLength": f.exact_length}
    if f.bounds is not None:
        out |= {"minimum": f.bounds[0], "maximum": f.bounds[1]}
    if f.fmt is not None:
        out["format"] = f.fmt
    if f.pattern is not None:
        out["pattern"] = f.pattern
    return out


def registered_contracts(created_topic: str = S.CREATED_TOPIC, invalid_topic: str = S.INVALID_TOPIC) -> list[dict]:
    """What a schema registry holds for the two topics."""
    titles = {created_topic: S.USER_CREATED_TYPE, invalid_topic: S.USER_PROFILE_INVALID_TYPE}
    return [
        {
            "topic": topic,
            "subject": f"{topic}-value",
            "schema_type": "JSON",
            "version": 1,
            "compatibility": COMPATIBILITY,
            "schema": json_schema(titles[topic], fields),
        }
        for topic, fields in contracts(created_topic, invalid_topic).items()
    ]


def _format_ok(fmt: str, text: Column) -> Column:
    if fmt == "email":
        return X.valid_email(text)
    if fmt == "date-time":
        return X.parse_timestamp(text).isNotNull()
    return X.valid_http_url(text)


def _conforms(f: S.Field, kind: Column, text: Column) -> Column:
    """True where a present, non-null value satisfies its field contract."""
    if f.kind == "object":
        return kind.startswith("OBJECT<")
    if f.kind == "reasons":
        items = F.from_json(F.when(kind.startswith("ARRAY<"), text), "array<variant>")
        ok = F.forall(items, lambda r: V.is_string(r) & (V.as_text(r) != ""))
        return (F.size(items) > 0) & ok
    if f.kind in ("integer", "number"):
        number = text.try_cast("double")
        ok = V.number_kind(kind)
        if f.kind == "integer":
            ok &= V.whole_number(text).isNotNull()
        return ok & X.in_bounds(number, *f.bounds) if f.bounds is not None else ok
    ok = kind == "STRING"
    if f.const is not None:
        return ok & (text == f.const)
    if f.required and f.fmt is None:
        ok &= text != ""
    if f.exact_length is not None:
        ok &= F.length(text) == f.exact_length
    if f.fmt is not None:
        ok &= _format_ok(f.fmt, text)
    if f.pattern is not None:
        ok &= text.rlike(rf"\A{f.pattern.strip('^$')}\z")
    return ok


def _violation(f: S.Field, kind: Column, text: Column) -> Column:
    broken = ~F.coalesce(_conforms(f, kind, text), F.lit(False))
    if f.required:
        return broken  # an absent value has no kind and conforms to nothing
    if f.kind == "object":  # may be left out, but not be null
        return kind.isNotNull() & broken
    if f.kind == "string" and (f.exact_length, f.fmt, f.pattern) == (None, None, None):
        return ~kind.isin("VOID", "STRING")
    return (kind != "VOID") & broken


def _message_rules(fields: Sequence[S.Field], kinds: Column, texts: Column, keys: Column) -> Column:
    names = F.array(*[F.lit(f.name) for f in fields])
    rules = [
        R.Rule(UNKNOWN_FIELDS, F.size(F.array_except(keys, names)) > 0),
        *[R.Rule(VIOLATION + f.name, _violation(f, kinds[f.name], texts[f.name])) for f in fields],
    ]
    return R.joined_codes(rules)


def parse_messages(df: DataFrame, value: str, names: Sequence[str], column: str) -> DataFrame:
    """Adds a struct with the JSON ``kinds`` of the named fields, their plain ``texts``, and all ``keys``.

    The text is parsed once. Null when it is not exactly one JSON object.
    """
    # Each step is used several times by the next, so Catalyst keeps them apart; the last one bars filters from all of them.
    df = df.withColumn("_sealed", V.sealed(F.col(value)))
    df = df.withColumn("_document", V.document(F.col("_sealed"), F.col(value)))
    opened = F.struct(
        V.as_struct(F.col("_document"), *names).alias("members"),
        F.map_keys(F.try_variant_get(F.col("_document"), "$", "map<string, variant>")).alias("keys"),
    )
    df = df.withColumn("_opened", opened)
    members = F.col("_opened")["members"]
    kinds = F.struct(*[V.kind(members[n]).alias(n) for n in names])
    texts = F.struct(*[V.as_text(members[n]).alias(n) for n in names])
    parsed = F.struct(kinds.alias("kinds"), texts.alias("texts"), F.col("_opened")["keys"].alias("keys"))
    df = df.withColumn(column, F.when(members.isNotNull(), parsed)).drop("_sealed", "_document", "_opened")
    return settle(df, {column: F.col(column)})


def check_messages(
    df: DataFrame,
    *,
    topic: str = "topic",
    value: str = "value",
    topic_contracts: Mapping[str, Sequence[S.Field]] | None = None,
    column: str = "violations",
    observe_as: str | None = None,
    keep_parsed: str | None = None,
) -> DataFrame:
    """Messages plus the ways each one breaks its topic's contract, empty when it conforms.

    A topic without a contract reports ``no_contract``; text that is no JSON object, ``invalid_json``.
    ``keep_parsed`` names a column to keep the parsed fields in, for read_created().
    """
    topic_contracts = contracts() if topic_contracts is None else topic_contracts
    names = list(dict.fromkeys(f.name for fields in topic_contracts.values() for f in fields))
    df = parse_messages(df, value, names, "_message")
    root, out = F.col("_message"), None
    for name, fields in topic_contracts.items():
        violations = _message_rules(fields, root["kinds"], root["texts"], root["keys"])
        out = (F if out is None else out).when(F.col(topic) == name, violations)
    broken = F.when(~F.col(topic).isin(list(topic_contracts)) | F.col(topic).isNull(), F.lit(NO_CONTRACT))
    broken = broken.when(root.isNull(), F.lit(INVALID_JSON))
    counts = {"messages": F.count(F.lit(1)), "violating": F.count_if(F.col("_codes") != "")}
    observed = settle(df, {"_codes": broken.otherwise(out)}, observe_as, **counts)
    observed = observed.withColumn(column, R.split_codes(F.col("_codes"))).drop("_codes")
    return observed.withColumnRenamed("_message", keep_parsed) if keep_parsed else observed.drop("_message")


def read_created(df: DataFrame, parsed: str) -> DataFrame:
    """Profile fields of parsed messages, for check_profiles().

    Only values of the right JSON kind come through; others become null, and the reasons of
    check_messages() tell why.
    """
    columns = {}
    for f in S.USER_CREATED_FIELDS:
        kind, text = F.col(parsed)["kinds"][f.name], F.col(parsed)["texts"][f.name]
        if f.kind == "string":
            columns[f.name] = F.when(kind == "STRING", text)
        else:
            number = text.try_cast("double") if f.kind == "number" else V.whole_number(text)
            columns[f.name] = F.when(V.number_kind(kind), number)
    return df.withColumns(columns).drop(parsed)

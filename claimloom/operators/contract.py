"""The strict contract of provider payloads: faults of every claim, the values of accepted ones, and a request's JSON schema.

A field is a kind (text, name, date, number, count, or a list of the values it may have), whether it may be null, and
whether it may be absent. Both the check and the schema are derived from FIELDS, so they can't differ.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions import vocabulary as V


FAULTS = "array<struct<claim_array:string,pos:int,fault:string>>"


class Field(NamedTuple):
    kind: str | list[str]
    null: bool = False
    absent: bool = False


_ALL = {"claim_type": Field("text"), "coverage_obligation_id": Field("name"), "confidence": Field(V.CONFIDENCES), "quote_text": Field("text")}
#: The fields of each claim array; an item's claim_type is the array's name without _claims.
FIELDS: dict[str, dict[str, Field]] = {
    "actor_claims": {"actor_label": Field("text"), "actor_kind": Field(V.ACTOR_KINDS), "observability": Field(V.OBSERVABILITIES)},
    "event_claims": {
        "event_type": Field(V.EVENT_TYPES), "event_subtype": Field(V.EVENT_SUBTYPES), "event_date": Field("date", null=True), "description": Field("text"), "actor_label": Field("text", null=True), "actor_role": Field(V.EVENT_ROLES, null=True),
    },
    "bid_claims": {
        "bidder_label": Field("text"), "bid_date": Field("date", null=True), "bid_value": Field("number", null=True), "bid_value_lower": Field("number", null=True), "bid_value_upper": Field("number", null=True),
        "bid_value_unit": Field("text", null=True), "consideration_type": Field("text", null=True), "bid_stage": Field(V.BID_STAGES),
    },
    "participation_count_claims": {
        "process_stage": Field(V.PROCESS_STAGES), "actor_class": Field(V.ACTOR_CLASSES), "count_min": Field("count"), "count_max": Field("count", null=True, absent=True), "count_qualifier": Field(V.COUNT_QUALIFIERS),
    },
    "actor_relation_claims": {"subject_label": Field("text"), "object_label": Field("text"), "relation_type": Field(V.RELATION_TYPES), "role_detail": Field("text", null=True), "effective_date_first": Field("date", null=True)},
}
FIELDS = {name: {**_ALL, "claim_type": Field([name.removesuffix("_claims")]), **own} for name, own in FIELDS.items()}


#: A number as text: digits with or without a point and an exponent, and white space around.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
WHOLE = r"^\s*[+]?[0-9]+\s*$"


def number_value(text: Column) -> Column:
    """The double that a number's text stands for, be it of a JSON number or string; null for any other text, and beyond a double."""
    value = F.trim(F.regexp_replace(text, r"^\s+|\s+$", "")).try_cast("double")
    return F.when(text.rlike(NUMBER) & (F.abs(value) < float("inf")), value)


def count_value(text: Column, number: Column | None = None) -> Column:
    """The long that a count's text stands for: whole, in any spelling of a number, and not below zero; else null. `number` may give the text's number_value, if it is at hand."""
    digits = F.when(text.rlike(WHOLE), F.regexp_replace(text, r"^\s*\+?|\s+$", "").try_cast("bigint"))
    number = number_value(text) if number is None else number
    return F.coalesce(digits, F.when((number >= 0) & (number == F.floor(number)) & (number < 2.0**53), number.cast("bigint")))


def is_object(text: Column) -> Column:
    """Whether a text is one JSON object and nothing else.

    The text is counted as the first item of two arrays, of two and of three: had the array ended within the text, both
    would have the same number. No key is made up for this, as a parser keeps every key that it meets.
    """
    length = lambda tail: F.json_array_length(F.concat(F.lit("["), text, F.lit(tail)))
    return F.coalesce(text.rlike(r"^[ \t\n\r]*\{") & (length(",0]") == 2) & (length(",0,0]") == 3), F.lit(False))


def keys_of(text: Column) -> Column:
    """The keys of a text that is one JSON object and nothing else; null for any other."""
    return F.when(is_object(text), F.json_object_keys(text))


def _rules(spark: SparkSession) -> DataFrame:
    """(claim_array, field, kind, listed, nullable) of each of FIELDS; listed is null where any value of the kind is good."""
    listed = lambda f: F.array(*map(F.lit, f.kind)) if isinstance(f.kind, list) else F.lit(None).cast("array<string>")
    rows = [F.struct(F.lit(name).alias("claim_array"), F.lit(n).alias("field"), F.lit("list" if isinstance(f.kind, list) else f.kind).alias("kind"), listed(f).alias("listed"), F.lit(f.null).alias("nullable")) for name, fields in FIELDS.items() for n, f in fields.items()]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))


def payload_faults(payloads: DataFrame, ident: str = "request_id", json_col: str = "payload") -> DataFrame:
    """(ident, claim_array, pos, fault) of every fault; payloads without a row here keep the contract.

    Faults: `malformed` (not one JSON object, or text before or after it; claim_array and pos null), `unknown NAME` for a key at the top, `not an
    array`, and of items `not an object`, `unknown NAME`, `missing NAME`, `bad NAME` (the wrong type, a value that is
    not of its list, a date that no calendar has, a number that can't be read, a count below zero, a null where none
    may be). A null payload is malformed, and an absent array is an empty one. Native expressions: payloads are
    exploded into arrays, these into items and these into fields, in one pass; nothing is shuffled.
    """
    text, c = F.col(json_col), F.col
    known = list(FIELDS)
    # What an explode takes apart is made by the projection ahead of it, which is compiled, as the explode itself is not. What is
    # found wrong on the way is carried along as `told`, and an outer explode keeps the row that carries it.
    made = payloads.select(ident, is_object(text).alias("whole"), text.alias("text")).select(ident, F.when(~c("whole"), F.array(F.lit("malformed"))).alias("told"), F.when(c("whole"), F.from_json("text", "map<string,string>")).alias("x"))
    top = made.select(ident, "told", F.explode_outer("x").alias("name", "items")).where("told is not null or name is not null")
    what = F.when(~c("name").isin(known), F.concat(F.lit("unknown "), "name")).when(~F.coalesce(c("items").startswith("["), F.lit(False)), "not an array")
    told = F.coalesce("told", F.when(what.isNotNull(), F.array(what)))
    arrays = top.select(ident, F.when(c("name").isin(known), c("name")).alias("claim_array"), told.alias("told"), F.when(told.isNull(), F.from_json("items", "array<string>")).alias("x"))
    items = arrays.select(ident, "claim_array", "told", F.posexplode_outer("x").alias("pos", "item")).where("told is not null or pos is not null")
    due = F.create_map(*(x for n, fields in FIELDS.items() for x in (F.lit(n), F.array(*(F.lit(k) for k, f in fields.items() if not f.absent)))))
    keyed = items.select(ident, "claim_array", "pos", "told", F.json_object_keys("item").alias("keys"), F.from_json("item", "map<string,variant>").alias("x"))
    lacking = F.transform(F.array_except(F.element_at(due, c("claim_array")), c("keys")), lambda k: F.concat(F.lit("missing "), k))
    told = F.when(c("told").isNotNull(), c("told")).when(c("keys").isNull(), F.array(F.lit("not an object"))).otherwise(lacking)
    fields = keyed.select(ident, "claim_array", "pos", told.alias("told"), F.when(c("keys").isNotNull(), c("x")).alias("x")).select(ident, "claim_array", "pos", "told", F.posexplode_outer("x").alias("at", "field", "value"))
    first = F.when((F.coalesce("at", F.lit(0)) == 0) & (F.size("told") > 0), c("told"))  # what an item lacks as a whole is told once
    typed = fields.select(ident, "claim_array", "pos", first.alias("told"), "field", F.try_variant_get("value", "$", "string").alias("text"), F.schema_of_variant("value").alias("type"))
    typed = typed.withColumn("number", number_value(c("text")))  # once a field and ahead of the join: what the filter behind it computes again must stay small, or the JVM doesn't compile it
    looked = typed.join(F.broadcast(_rules(payloads.sparkSession)), ["claim_array", "field"], "left")
    is_text = c("type") == "STRING"
    good = (
        F.when(c("type") == "VOID", c("nullable"))
        .when(c("kind") == "list", is_text & F.array_contains("listed", c("text")))
        .when(c("kind") == "date", is_text & c("text").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.try_to_timestamp("text", F.lit("yyyy-MM-dd")).isNotNull())
        .when(c("kind") == "number", c("number").isNotNull())
        .when(c("kind") == "count", count_value(c("text"), c("number")).isNotNull())
        .when(c("kind") == "name", is_text & (c("text") != ""))
        .otherwise(is_text)
    )
    fault = F.when(c("kind").isNull(), F.concat(F.lit("unknown "), "field")).when(~F.coalesce(good, F.lit(False)), F.concat(F.lit("bad "), "field"))
    found = looked.select(ident, "claim_array", "pos", "told", fault.alias("fault")).where("told is not null or fault is not null")
    return found.select(ident, "claim_array", "pos", F.explode(F.concat(F.coalesce("told", F.array().cast("array<string>")), F.array_compact(F.array("fault")))).alias("fault"))


# What bids and relations may be where their obligations ask for one thing alone.
NARROWED = {("bid", "Final bid price"): ("bid_claims", "bid_stage", ["final"]), ("actor_relation", "Buyer group composition"): ("actor_relation_claims", "relation_type", ["member_of", "affiliate_of", "controls", "acquisition_vehicle_of"])}


def request_schema(lists: dict[tuple[str, str], object] | None = None) -> str:
    """The JSON schema of a payload: closed objects, every field required, nulls spelled out, no keyword that strict providers refuse.

    lists: values that a field of an array may have, in place of its own.
    """

    def value(name: str, field_name: str, field: Field) -> dict:
        kinds = {"text": "string", "name": "string", "date": "string", "number": "number", "count": "integer"}
        kind = "string" if isinstance(field.kind, list) else kinds[field.kind]
        out: dict = {"type": [kind, "null"] if field.null else kind}
        if (own := (lists or {}).get((name, field_name))) is not None:
            out["enum"] = own
        elif isinstance(field.kind, list):
            out["enum"] = [*field.kind, None] if field.null else field.kind
        return out

    item = lambda name, fields: {"type": "object", "additionalProperties": False, "required": list(fields), "properties": {n: value(name, n, f) for n, f in fields.items()}}
    arrays = {name: {"type": "array", "items": item(name, fields)} for name, fields in FIELDS.items()}
    return json.dumps({"type": "object", "additionalProperties": False, "required": list(FIELDS), "properties": arrays}, sort_keys=True)


def schema_of(obligations: Column) -> Column:
    """A request's own schema, from its array of obligations (obligation_id, expected_claim_type, obligation_label).

    A claim names one of the request's obligations of its type; of a type without any, a name that none has. Bids are
    final ones and relations those of a group where that is all the obligations of the type ask for. The text between
    the lists is the same for all requests; lists are put in row by row.
    """
    lists: dict[tuple[str, str], Column] = {}
    for name in FIELDS:
        kind = name.removesuffix("_claims")
        ids = F.transform(F.filter(obligations, lambda o: o["expected_claim_type"] == kind), lambda o: o["obligation_id"])  # noqa: B023
        lists[name, "coverage_obligation_id"] = F.when(F.size(ids) > 0, ids).otherwise(F.array(F.lit(f"__no_{kind}_coverage_obligation__")))
    for (kind, label), (name, field, values) in NARROWED.items():
        mine = F.filter(obligations, lambda o: o["expected_claim_type"] == kind)  # noqa: B023
        only = (F.size(mine) > 0) & F.forall(mine, lambda o: F.coalesce(o["obligation_label"] == label, F.lit(False)))  # noqa: B023
        lists[name, field] = F.when(only, F.array(*map(F.lit, values))).otherwise(F.array(*map(F.lit, FIELDS[name][field].kind)))
    places = {f"\x00{i}\x00": where for i, where in enumerate(lists)}
    text = request_schema({where: mark for mark, where in places.items()})
    parts, at = [], 0
    for mark, where in sorted(((json.dumps(m), w) for m, w in places.items()), key=lambda x: text.index(x[0])):
        k = text.index(mark)
        parts += [F.lit(text[at:k]), F.to_json(lists[where])]
        at = k + len(mark)
    return F.concat(*parts, F.lit(text[at:]))


def keeping(payloads: DataFrame, ident: str = "request_id", json_col: str = "payload") -> DataFrame:
    """The payloads without any fault."""
    return payloads.join(payload_faults(payloads, ident, json_col).select(ident).distinct(), ident, "left_anti")


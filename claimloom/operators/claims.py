"""Claims from provider payloads: parsing, contract checks, quote binding, coverage.

A payload is accepted whole or not at all: requests with any violation drop out by an anti-join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions import text as X
from claimloom.functions import vocabulary as V
from claimloom.functions.ids import numbered
from claimloom.operators.contract import count_value, keys_of, number_value
from claimloom.sources.shared import stored

_COMMON = "claim_type string, coverage_obligation_id string, confidence string, quote_text string"
#: One array of structs for each claim type, in the order in which claims are taken.
PAYLOAD = {
    "actor_claims": f"{_COMMON}, actor_label string, actor_kind string, observability string",
    "event_claims": f"{_COMMON}, event_type string, event_subtype string, event_date string, description string, actor_label string, actor_role string",
    "bid_claims": f"{_COMMON}, bidder_label string, bid_date string, bid_value double, bid_value_lower double, bid_value_upper double, bid_value_unit string, consideration_type string, bid_stage string",
    "participation_count_claims": f"{_COMMON}, process_stage string, actor_class string, count_min bigint, count_max bigint, count_qualifier string",
    "actor_relation_claims": f"{_COMMON}, subject_label string, object_label string, relation_type string, role_detail string, effective_date_first string",
}
#: As read: numbers and counts are taken as text, and decoded by the expressions with which the contract checks them.
SCHEMA = ", ".join(f"{name}: array<struct<{fields.replace(' double', ' string').replace(' bigint', ' string')}>>" for name, fields in PAYLOAD.items())
_DECODED = {"double": number_value, "bigint": count_value}


def parse_payloads(payloads: DataFrame, json_col: str = "payload") -> DataFrame:
    """payloads with the parsed struct `parsed` and `parse_error`: malformed, or a key that no claim array has.

    Items are taken as they are; operators.contract finds their faults.
    """
    parsed = payloads.withColumn("parsed", F.from_json(json_col, f"struct<{SCHEMA}>"))
    keys = keys_of(F.col(json_col))
    unknown = F.exists(keys, lambda k: ~k.isin(list(PAYLOAD)))
    return parsed.withColumn("parse_error", F.when(keys.isNull() | F.col("parsed").isNull(), "malformed").when(unknown, "unknown_key"))


def flatten(parsed: DataFrame, ident: str = "request_id") -> DataFrame:
    """One row for each claim, in the fixed order of types, then of places; typed fields that a type lacks are null.

    A number or count that the contract accepts arrives, however it is spelled; one that it refuses is null here.
    """
    kinds = {f.split(" ")[0]: f.split(" ")[1] for fields in PAYLOAD.values() for f in fields.split(", ")}
    none = F.array().cast("array<struct<type_order: int, pos: int, " + ", ".join(f"{f}: {t}" for f, t in kinds.items()) + ">>")

    def rows(order: int, name: str) -> Column:
        own = {f.split(" ")[0] for f in PAYLOAD[name].split(", ")}
        value = lambda x, f, t: F.lit(None).cast(t) if f not in own else _DECODED[t](x[f]) if t in _DECODED else x[f]
        return F.coalesce(F.transform(F.col(f"parsed.{name}"), lambda x, i: F.struct(F.lit(order).alias("type_order"), i.cast("int").alias("pos"), *(value(x, f, t).alias(f) for f, t in kinds.items()))), none)

    return parsed.select(ident, F.explode(F.concat(*(rows(i, name) for i, name in enumerate(PAYLOAD)))).alias("c")).select(ident, "c.*")


def word_pairs(words: Column) -> Column:
    """The distinct hashes of each two words that follow one another."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.xxhash64(a, b)))


def asked_pairs(claims: DataFrame, window: str = "window_id") -> DataFrame:
    """(window, claim_key, pair) of each quote; its first and last word may be cut from longer ones, so only the words between them count."""
    words = F.split("quote_text", " ")
    inner = F.slice(words, F.lit(2), F.greatest(F.size(words) - 2, F.lit(0)))
    return claims.select(window, "claim_key", F.explode(word_pairs(inner)).alias("pair"))


def held_pairs(paragraphs: DataFrame, pairs: DataFrame, *keep: str) -> DataFrame:
    """(*keep, pair) of each paragraph, of those pairs that stand in `pairs`: whichever quote has them, in this window or another."""
    held = paragraphs.select(*keep, F.explode(word_pairs(F.split("paragraph_text", " "))).alias("pair"))
    return held.join(pairs, "pair", "left_semi")


def _rarest(asked: DataFrame, held: DataFrame, window: str) -> DataFrame:
    counts = held.groupBy(window, "pair").agg(F.count("*").alias("n"))
    rarity = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "pair")
    rarest = asked.join(counts, [window, "pair"], "left").groupBy(window, "claim_key").agg(F.min(rarity).alias("rarest"))
    return rarest.where("rarest.n > 0").select(window, "claim_key", "rarest.pair")


def quote_anchors(claims: DataFrame, paragraphs: DataFrame, window: str = "window_id") -> DataFrame:
    """(window, claim_key, pair): the rarest pair of words of each quote that has any and may stand in its window.

    How rare a pair is follows from one count over the window's paragraphs, of pairs that some quote has; a quote with a
    pair that no paragraph has is left out, as it can't stand there.
    """
    asked = asked_pairs(claims, window)
    return _rarest(asked, held_pairs(paragraphs, asked.select("pair").distinct(), window), window)


def bind_quotes(claims: DataFrame, paragraphs: DataFrame, window: str = "window_id") -> DataFrame:
    """(claim_key, hits, paragraph_id, char_start, char_end): where each claim's quote stands in its window.

    `claims` has claim_key, the window and quote_text, `paragraphs` the window, paragraph_id, char_start and
    paragraph_text. A quote binds if it occurs exactly once over the window, overlapping places counted; with 0 or
    2 or more hits the place is null. Null and empty quotes have no hits.

    An inverted index finds where to look: each quote is anchored by its rarest pair of words (see quote_anchors), and
    only paragraphs of its window that hold the pair are searched for it. Quotes of fewer than four words have no whole
    pair; they are looked for in all paragraphs of their window.

    The pairs asked for, the index of those, the anchors, the places to look and short quotes are stored one after the other. So texts
    are taken apart once, and each table's size is known ahead of its join: while it is small it is broadcast, and
    neither the pairs of all texts nor the texts are shuffled.
    """
    asked = claims.select(window, "claim_key", "quote_text").where("quote_text <> ''")
    pairs = asked_pairs(asked, window)
    held = stored(held_pairs(paragraphs, stored(pairs.select("pair").distinct(), "asked_pairs"), window, "paragraph_id"), "held_pairs")
    anchors = stored(_rarest(pairs, held, window), "anchors")
    may = held.join(anchors, [window, "pair"]).select(window, "claim_key", "paragraph_id").distinct()
    anchored = stored(may.join(asked, [window, "claim_key"]), "places").join(paragraphs, [window, "paragraph_id"])
    short = stored(asked.where(F.size(F.split("quote_text", " ")) < 4), "short_quotes").join(paragraphs.select(window, "paragraph_id", "char_start", "paragraph_text"), window)
    columns = ["claim_key", "quote_text", "paragraph_id", "char_start", "paragraph_text"]
    looked = anchored.select(*columns).unionByName(short.select(*columns))
    at = F.call_function("instr", F.col("paragraph_text"), F.col("quote_text"))
    n = F.coalesce(X.occurrences(F.col("paragraph_text"), F.col("quote_text")), F.lit(0))
    place = F.struct("paragraph_id", (F.col("char_start") + at - 1).alias("start"))
    hits = looked.select("claim_key", n.alias("n"), F.when(n > 0, place).alias("place"), F.length("quote_text").alias("size")).where("n > 0")
    none = claims.select("claim_key", F.lit(0).alias("n"), F.lit(None).cast(hits.schema["place"].dataType).alias("place"), F.lit(None).cast("int").alias("size"))
    found = hits.unionByName(none).groupBy("claim_key").agg(F.sum("n").cast("int").alias("hits"), F.min("place").alias("place"), F.max("size").alias("size"))
    one = F.col("hits") == 1
    return found.select("claim_key", "hits", F.when(one, F.col("place.paragraph_id")).alias("paragraph_id"), F.when(one, F.col("place.start")).alias("char_start"), F.when(one, F.col("place.start") + F.col("size")).alias("char_end"))


def quote_status(hits: Column) -> Column:
    return F.when(hits == 0, "absent").when(hits == 1, "unique").otherwise("ambiguous")


def violations(claims: DataFrame, obligations: DataFrame) -> DataFrame:
    """(deal_slug, claim_id, violation): claims of no allowed type, or linked to no obligation or one of another type; and obligations listed twice."""
    duties = obligations.select(F.col("obligation_id").alias("duty"), F.col("expected_claim_type").alias("due"))
    joined = claims.join(duties.dropDuplicates(["duty"]), F.col("coverage_obligation_id") == F.col("duty"), "left")
    what = F.when(~F.col("claim_type").isin(V.CLAIM_TYPES), "type_not_allowed").when(F.col("duty").isNull(), "unknown_obligation").when(F.col("due") != F.col("claim_type"), "obligation_of_other_type")
    bad = joined.select("deal_slug", "claim_id", what.alias("violation")).where("violation is not null")
    twice = obligations.groupBy("deal_slug", "obligation_id").count().where("count > 1").select("deal_slug", F.col("obligation_id").alias("claim_id"), F.lit("duplicate_obligation").alias("violation"))
    return bad.unionByName(twice)


def accepted(claims: DataFrame, violations_: DataFrame, on: str = "deal_slug") -> DataFrame:
    """The claims of requests without any violation."""
    return claims.join(violations_.select(on).distinct(), on, "left_anti")


def coverage_results(obligations: DataFrame, claims: DataFrame) -> DataFrame:
    """One current result for each obligation: emitted or missed, and the number of claims linked to it."""
    linked = claims.groupBy(F.col("coverage_obligation_id").alias("obligation_id")).agg(F.count("*").alias("n"))
    rows = obligations.join(linked, "obligation_id", "left").withColumn("claim_count", F.coalesce("n", F.lit(0)).cast("int"))
    rows = numbered(rows, "coverage", [F.regexp_extract("obligation_id", "_([0-9]+)$", 1).cast("int")], "coverage_result_id")
    some = F.col("claim_count") > 0
    return rows.select("coverage_result_id", "deal_slug", "obligation_id", F.when(some, "claims_emitted").otherwise("missed").alias("result"), F.when(some, "claims_linked").otherwise("no_linked_claim").alias("reason_code"), "claim_count", F.lit(True).alias("current"))


def raw_value() -> Column:
    """A claim's own words, by type, from the columns of a wide claim."""
    c, kind = F.col, F.col("claim_type")
    return (
        F.when(kind == "actor", c("actor_label"))
        .when(kind == "event", c("description"))
        .when(kind == "bid", F.concat_ws(":", c("bidder_label"), X.python_float(F.coalesce("bid_value", "bid_value_lower"))))
        .when(kind == "participation_count", F.concat_ws(":", c("process_stage"), c("actor_class"), c("count_min").cast("string")))
        .otherwise(F.concat_ws(":", c("subject_label"), c("relation_type"), c("object_label")))
    )


def normalized_value() -> Column:
    """A claim's value in one form: an ISO date, a number, a range, a count; else null."""
    c, kind = F.col, F.col("claim_type")
    bounds = c("bid_value_lower").isNotNull() | c("bid_value_upper").isNotNull()
    return (
        F.when((kind == "event") & c("event_date").isNotNull(), F.date_format("event_date", "yyyy-MM-dd"))
        .when((kind == "bid") & c("bid_value").isNotNull(), c("bid_value").cast("string"))
        .when((kind == "bid") & bounds, F.concat_ws("-", X.python_float(c("bid_value_lower")), X.python_float(c("bid_value_upper"))))
        .when(kind == "participation_count", c("count_min").cast("string"))
    )

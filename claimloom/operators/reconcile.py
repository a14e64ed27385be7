"""Typed claims to the canonical graph, as joins and windows.

`claims` is wide: deal_slug, claim_id, claim_sequence, claim_type, raw_value, confidence, evidence_id (the first by
ordinal), the typed fields of all five types, and optionally has_typed (false where the typed row is missing).
A slug's claims are taken in the order of (claim_sequence, claim_id); every identifier follows from that order.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions import text as X
from claimloom.functions.ids import make_id, numbered

ORDER = ["claim_sequence", "claim_id"]


def first_evidence(links: DataFrame) -> DataFrame:
    """The evidence of least ordinal of each claim."""
    return links.groupBy("claim_id").agg(F.min_by("evidence_id", "ordinal").alias("evidence_id"))


def _target() -> list[Column]:
    """Aggregates of a slug's claims: `named`, the first actor claim's words that hold the slug's first word, and `evidence_id`, the first claim's."""
    word = F.lower(F.element_at(F.split("deal_slug", "-"), 1))
    hit = (F.col("claim_type") == "actor") & F.contains(F.lower("raw_value"), word)
    order = F.struct(*ORDER)
    return [F.min_by("raw_value", F.when(hit, order)).alias("named"), F.min_by("evidence_id", order).alias("evidence_id")]


def _target_label() -> Column:
    return F.coalesce(X.canonical_label(F.col("named")), F.initcap(F.replace(F.col("deal_slug"), F.lit("-"), F.lit(" "))))


def target_labels(claims: DataFrame) -> DataFrame:
    """(deal_slug, label, evidence_id): the first actor claim that holds the slug's first word, else the slug's words with capitals."""
    return claims.groupBy("deal_slug").agg(*_target()).select("deal_slug", _target_label().alias("label"), "evidence_id")


def usable(claims: DataFrame) -> Column:
    return F.col("has_typed") if "has_typed" in claims.columns else F.lit(True)


def mentions(claims: DataFrame) -> DataFrame:
    """(deal_slug, label, claim_id, claim_sequence, ordinal, kind, observability, evidence_id): every label that needs an actor, the target first."""
    c = F.col
    named = lambda label, ordinal, kind=F.lit("organization"), seen=F.lit("named"): F.struct(X.canonical_label(c(label)).alias("label"), F.lit(ordinal).alias("ordinal"), kind.alias("kind"), seen.alias("observability"))
    own = F.array_compact(F.array(
        F.when(c("claim_type") == "actor", named("actor_label", 0, c("actor_kind"), c("observability"))),
        F.when((c("claim_type") == "event") & linked_event(), named("event_actor_label", 0)),
        F.when((c("claim_type") == "bid") & ~X.is_generic_label(c("bidder_label")), named("bidder_label", 0)),
        F.when(c("claim_type") == "actor_relation", named("subject_label", 0)),
        F.when(c("claim_type") == "actor_relation", named("object_label", 1)),
    ))
    columns = ["deal_slug", "label", "claim_id", "claim_sequence", "ordinal", "kind", "observability", "evidence_id"]
    made = claims.where(usable(claims)).select("deal_slug", "claim_id", "claim_sequence", "evidence_id", F.explode(own).alias("m")).select("*", "m.*").select(*columns)
    target = target_labels(claims).select("deal_slug", "label", F.lit("").alias("claim_id"), F.lit(0).alias("claim_sequence"), F.lit(0).alias("ordinal"), F.lit("organization").alias("kind"), F.lit("named").alias("observability"), "evidence_id")
    return target.unionByName(made)


def linked_event() -> Column:
    return (F.coalesce("event_actor_label", F.lit("")) != "") & (F.coalesce("event_actor_role", F.lit("")) != "")


def actors(claims: DataFrame) -> DataFrame:
    """One actor for each label of a slug, numbered by first mention; `claim_id` is the mention that made it."""
    order = [*ORDER, "ordinal"]
    first = mentions(claims).withColumn("rank", F.row_number().over(Window.partitionBy("deal_slug", "label").orderBy("claim_sequence", "claim_id", "ordinal"))).where("rank = 1")
    return numbered(first, "actor", order, "actor_id").select("deal_slug", "actor_id", "label", "kind", "observability", "evidence_id", "claim_id", "ordinal")


def with_actor(df: DataFrame, label: str, actors_: DataFrame, name: str, **more: str) -> DataFrame:
    """df with the id of the actor that a label stands for, and more of the actor's columns (new name = column)."""
    keyed, key = df.withColumn(f"{name}_label_key", X.canonical_label(F.col(label))), f"{name}_label_key"
    who = actors_.select("deal_slug", F.col("label").alias(key), F.col("actor_id").alias(name), *(F.col(v).alias(k) for k, v in more.items()))
    return keyed.join(who, ["deal_slug", key], "left").drop(key)


def deals(claims: DataFrame) -> DataFrame:
    """One deal and one cycle for each slug, with its target actor and the latest event or bid date."""
    day = F.when(usable(claims), F.when(F.col("claim_type") == "event", F.col("event_date")).when(F.col("claim_type") == "bid", F.col("bid_date")))
    slug = F.col("deal_slug")
    found = claims.groupBy("deal_slug").agg(*_target(), F.min(day).alias("start_date"), F.max(day).alias("end_date"))
    return found.withColumn("label", _target_label()).select(
        "deal_slug", make_id(slug, "deal", F.lit(1)).alias("deal_id"), make_id(slug, "cycle", F.lit(1)).alias("cycle_id"), make_id(slug, "actor", F.lit(1)).alias("target_actor_id"),
        F.col("label").alias("target_label"), "start_date", "end_date", F.col("end_date").alias("announcement_date"), "evidence_id",
    )


def events(claims: DataFrame) -> DataFrame:
    """Event claims and accepted bid claims as events, under one sequence."""
    c = F.col
    bid = c("claim_type") == "bid"
    rows = claims.where(usable(claims) & ((c("claim_type") == "event") | (bid & ~X.is_generic_label(c("bidder_label")))))
    made = numbered(rows, "event", ORDER, "event_id")
    only = lambda col: F.when(bid, c(col))
    return made.select(
        "deal_slug", "event_id", make_id(c("deal_slug"), "cycle", F.lit(1)).alias("cycle_id"), F.when(bid, "bid").otherwise(c("event_type")).alias("event_type"),
        F.when(bid, F.when(c("bid_stage") == "final", "final_round_bid").otherwise("first_round_bid")).otherwise(c("event_subtype")).alias("event_subtype"),
        F.when(bid, c("bid_date")).otherwise(c("event_date")).alias("event_date"), only("bid_value").alias("bid_value"), only("bid_value_lower").alias("bid_value_lower"), only("bid_value_upper").alias("bid_value_upper"),
        F.when(bid, F.concat("bidder_label", F.lit(" bid"))).otherwise(c("description")).alias("description"), "claim_id", "claim_sequence", "evidence_id",
        F.when(bid, c("bidder_label")).when(linked_event(), c("event_actor_label")).alias("link_label"), F.when(bid, "bid_submitter").when(linked_event(), c("event_actor_role")).alias("link_role"),
    )


def event_links(events_: DataFrame, actors_: DataFrame) -> DataFrame:
    """The actor of each event that names one with a role."""
    rows = with_actor(events_.where("link_label is not null"), "link_label", actors_, "actor_id")
    return numbered(rows, "link", ORDER, "link_id").select("deal_slug", "link_id", "event_id", "actor_id", F.col("link_role").alias("role"), "evidence_id", "claim_id")


def relations(claims: DataFrame, actors_: DataFrame) -> DataFrame:
    rows = claims.where(usable(claims) & (F.col("claim_type") == "actor_relation"))
    rows = with_actor(with_actor(rows, "subject_label", actors_, "subject_actor_id"), "object_label", actors_, "object_actor_id")
    rows = numbered(rows, "relation", ORDER, "relation_id")
    return rows.select("deal_slug", "relation_id", "subject_actor_id", "object_actor_id", "relation_type", "role_detail", make_id(F.col("deal_slug"), "cycle", F.lit(1)).alias("cycle_id_first"), "effective_date_first", "confidence", "evidence_id", "claim_id")


def participation_counts(claims: DataFrame) -> DataFrame:
    rows = claims.where(usable(claims) & (F.col("claim_type") == "participation_count"))
    rows = numbered(rows, "count", ORDER, "participation_count_id")
    return rows.select("deal_slug", "participation_count_id", make_id(F.col("deal_slug"), "cycle", F.lit(1)).alias("cycle_id"), "process_stage", "actor_class", "count_min", "count_max", "count_qualifier", F.lit(0).alias("anonymous_remainder_count"), "evidence_id", "claim_id")


def dispositions(claims: DataFrame, actors_: DataFrame, events_: DataFrame, counts: DataFrame, relations_: DataFrame) -> DataFrame:
    """What became of each claim: one current disposition, in the order of the claims."""
    c, kind = F.col, F.col("claim_type")
    made = (
        events_.select("claim_id", F.lit("events").alias("canonical_table"), F.col("event_id").alias("canonical_id"))
        .unionByName(counts.select("claim_id", F.lit("participation_counts").alias("canonical_table"), F.col("participation_count_id").alias("canonical_id")))
        .unionByName(relations_.select("claim_id", F.lit("actor_relations").alias("canonical_table"), F.col("relation_id").alias("canonical_id")))
    )
    rows = with_actor(claims.withColumn("typed", usable(claims)), "actor_label", actors_, "actor_id", first_claim="claim_id", first_ordinal="ordinal").join(made, "claim_id", "left")
    own = F.coalesce((c("first_claim") == c("claim_id")) & (c("first_ordinal") == 0), F.lit(False))
    known = kind.isin("actor", "event", "bid", "participation_count", "actor_relation")
    generic = (kind == "bid") & X.is_generic_label(c("bidder_label"))
    what = F.when(~known, "out_of_scope").when(~c("typed"), "rejected").when(generic, "rejected").when((kind == "actor") & ~own, "merged_duplicate").otherwise("canonicalized")
    why = (
        F.when(~known, "unsupported_claim_type")
        .when(~c("typed"), F.concat(F.lit("missing_"), kind, F.lit("_claim")))
        .when(generic, "generic_bidder_label_not_projectable")
        .when(kind == "actor", "actor_label_canonicalized")
        .when(kind == "participation_count", "participation_count_canonicalized")
        .when(kind == "actor_relation", "actor_relation_canonicalized")
        .otherwise(F.concat(kind, F.lit("_claim_canonicalized")))
    )
    actor = (kind == "actor") & c("typed")
    rows = numbered(rows, "disposition", ORDER, "disposition_id")
    return rows.select(
        "deal_slug", "disposition_id", "claim_id", what.alias("disposition"), why.alias("reason_code"),
        F.when(actor, "actors").otherwise(c("canonical_table")).alias("canonical_table"), F.when(actor, c("actor_id")).otherwise(c("canonical_id")).alias("canonical_id"), F.lit(True).alias("current"),
    )


#: Each canonical table and its key.
CANONICAL = {"deals": "deal_id", "process_cycles": "cycle_id", "actors": "actor_id", "actor_relations": "relation_id", "events": "event_id", "event_actor_links": "link_id", "participation_counts": "participation_count_id"}


def row_evidence(tables: dict[str, DataFrame]) -> DataFrame:
    """One provenance row for each row of the canonical tables."""
    parts = [df.select("deal_slug", F.lit(name).alias("row_table"), F.col(CANONICAL[name]).alias("row_id"), "evidence_id", F.lit(1).alias("ordinal")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def reconcile(claims: DataFrame, keep: Callable[[str, DataFrame], DataFrame] = lambda name, df: df) -> dict[str, DataFrame]:
    """All canonical tables of the claims. A slug without claims has none, so a run must not go on with it.

    `keep` may store a table under its name and give what reads it; later tables are then made from the stored ones,
    and whatever takes several of them need not make the graph again for each.
    """
    acts, evs, counts = keep("actors", actors(claims)), keep("events", events(claims)), keep("participation_counts", participation_counts(claims))
    rels, deals_, links = keep("actor_relations", relations(claims, acts)), keep("deals", deals(claims)), keep("event_actor_links", event_links(evs, acts))
    out = {"deals": deals_, "process_cycles": deals_, "actors": acts, "actor_relations": rels, "events": evs, "event_actor_links": links, "participation_counts": counts}
    return out | {"row_evidence": row_evidence(out), "claim_dispositions": dispositions(claims, acts, evs, counts, rels)}

"""Queries over claims made of the events: contracts, reconciliation, validation, projection, costs, cycles."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from claimloom.functions import ids
from claimloom.functions import text as X
from claimloom.functions import vocabulary as V
from claimloom.operators import claims as C
from claimloom.operators import cycles as Y
from claimloom.operators import project as P
from claimloom.operators import reconcile as R
from claimloom.operators import validate as Q
from claimloom.plans import adaptors as A
from claimloom.sources.shared import stored

c = F.col


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_TOK = "list_filter(string_split(regexp_replace(lower(replace({0}, '''', '’')), '[^a-z0-9]+', ' ', 'g'), ' '), lambda t: t <> '')"
GENERIC = (
    "(len(" + _TOK + ") = 0 OR list_contains(" + _list(V.GENERIC_LABELS) + ", array_to_string(" + _TOK + ", ' '))"
    " OR (len(list_filter(" + _TOK + ", lambda t: regexp_full_match(t, '[0-9]+') OR list_contains(" + _list(V.COUNT_WORDS) + ", t))) > 0 AND list_contains(" + _list(V.BIDDER_NOUNS) + ", " + _TOK + "[-1]))"
    " OR (len(list_filter(" + _TOK + ", lambda t: NOT list_contains(" + _list(V.BIDDER_NOUNS + V.BIDDER_MODIFIERS) + ", t))) = 0 AND len(list_filter(" + _TOK + ", lambda t: list_contains(" + _list(V.BIDDER_NOUNS) + ", t))) > 0))"
)


def _generic(col: str) -> str:
    return GENERIC.replace("{0}", col)


_CAN = "replace({}, '''', '’')"
LABELLED = f"gen AS (SELECT label AS raw_label, {_generic('label')} AS generic FROM (SELECT DISTINCT label FROM clm))"
MEN = f"""men AS (
  SELECT deal_slug, upper(deal_slug[1]) || deal_slug[2:] AS label, '' AS claim_id, 0 AS claim_sequence, 0 AS ordinal, 'organization' AS kind, 'named' AS observability, arg_min(evidence_id, claim_sequence) AS evidence_id FROM clm GROUP BY deal_slug
  UNION ALL SELECT deal_slug, {_CAN.format('label')}, claim_id, claim_sequence, 0, actor_kind, observability, evidence_id FROM clm WHERE claim_type = 'actor'
  UNION ALL SELECT deal_slug, {_CAN.format('label')}, claim_id, claim_sequence, 0, 'organization', 'named', evidence_id FROM clm WHERE claim_type = 'event' AND coalesce(event_actor_label, '') <> '' AND event_actor_role <> ''
  UNION ALL SELECT deal_slug, {_CAN.format('label')}, claim_id, claim_sequence, 0, 'organization', 'named', evidence_id FROM clm JOIN gen ON raw_label = label WHERE claim_type = 'bid' AND NOT generic
  UNION ALL SELECT deal_slug, {_CAN.format('label')}, claim_id, claim_sequence, 0, 'organization', 'named', evidence_id FROM clm WHERE claim_type = 'actor_relation'
  UNION ALL SELECT deal_slug, label2, claim_id, claim_sequence, 1, 'organization', 'named', evidence_id FROM clm WHERE claim_type = 'actor_relation'),
act0 AS (SELECT *, row_number() OVER (PARTITION BY deal_slug, label ORDER BY claim_sequence, claim_id, ordinal) AS r FROM men),
act AS (SELECT *, deal_slug || '_actor_' || row_number() OVER (PARTITION BY deal_slug ORDER BY claim_sequence, claim_id, ordinal) AS actor_id FROM act0 WHERE r = 1)"""
EVT = """evt AS (
  SELECT deal_slug, deal_slug || '_event_' || row_number() OVER (PARTITION BY deal_slug ORDER BY claim_sequence, claim_id) AS event_id, deal_slug || '_cycle_1' AS cycle_id,
    CASE WHEN claim_type = 'bid' THEN 'bid' ELSE 'process' END AS event_type, CASE WHEN claim_type = 'bid' THEN CASE bid_stage WHEN 'final' THEN 'final_round_bid' ELSE 'first_round_bid' END ELSE 'exclusivity_grant' END AS event_subtype,
    day AS event_date, CASE WHEN claim_type = 'bid' THEN bid_value END AS bid_value, CASE WHEN claim_type = 'bid' THEN bid_value_lower END AS bid_value_lower, CASE WHEN claim_type = 'bid' THEN bid_value_upper END AS bid_value_upper,
    CASE WHEN claim_type = 'bid' THEN label || ' bid' ELSE description END AS description, claim_id, claim_sequence, evidence_id,
    CASE WHEN claim_type = 'bid' THEN label WHEN coalesce(event_actor_label, '') <> '' AND event_actor_role <> '' THEN label END AS link_label,
    CASE WHEN claim_type = 'bid' THEN 'bid_submitter' ELSE event_actor_role END AS link_role
  FROM clm JOIN gen ON raw_label = label WHERE claim_type = 'event' OR (claim_type = 'bid' AND NOT generic)),
lnk2 AS (SELECT e.deal_slug, e.deal_slug || '_link_' || row_number() OVER (PARTITION BY e.deal_slug ORDER BY e.claim_sequence, e.claim_id) AS link_id, e.event_id, a.actor_id, link_role AS role, e.evidence_id
  FROM evt e JOIN act a ON a.deal_slug = e.deal_slug AND a.label = replace(e.link_label, '''', '’') WHERE link_label IS NOT NULL)"""
REL = """rel AS (SELECT x.deal_slug, x.deal_slug || '_relation_' || row_number() OVER (PARTITION BY x.deal_slug ORDER BY x.claim_sequence, x.claim_id) AS relation_id, s.actor_id AS subject_actor_id, o.actor_id AS object_actor_id, relation_type, role_detail, confidence, x.evidence_id, x.claim_id
  FROM clm x JOIN act s ON s.deal_slug = x.deal_slug AND s.label = replace(x.label, '''', '’') JOIN act o ON o.deal_slug = x.deal_slug AND o.label = x.label2 WHERE claim_type = 'actor_relation'),
cnt AS (SELECT deal_slug, deal_slug || '_count_' || row_number() OVER (PARTITION BY deal_slug ORDER BY claim_sequence, claim_id) AS participation_count_id, process_stage, actor_class, CAST(count_min AS INTEGER) AS count_min, CAST(count_max AS INTEGER) AS count_max, evidence_id, claim_id FROM clm WHERE claim_type = 'participation_count')"""
DIS = """dis AS (SELECT x.deal_slug, x.deal_slug || '_disposition_' || row_number() OVER (PARTITION BY x.deal_slug ORDER BY x.claim_sequence, x.claim_id) AS disposition_id, x.claim_id, claim_type,
    CASE WHEN claim_type = 'bid' AND generic THEN 'rejected' WHEN claim_type = 'actor' AND f.claim_id IS NULL THEN 'merged_duplicate' ELSE 'canonicalized' END AS disposition,
    CASE WHEN claim_type = 'bid' AND generic THEN 'generic_bidder_label_not_projectable' WHEN claim_type = 'actor' THEN 'actor_label_canonicalized' WHEN claim_type = 'participation_count' THEN 'participation_count_canonicalized'
      WHEN claim_type = 'actor_relation' THEN 'actor_relation_canonicalized' ELSE claim_type || '_claim_canonicalized' END AS reason_code,
    CASE WHEN claim_type = 'actor' THEN 'actors' WHEN e.event_id IS NOT NULL THEN 'events' WHEN participation_count_id IS NOT NULL THEN 'participation_counts' WHEN relation_id IS NOT NULL THEN 'actor_relations' END AS canonical_table,
    CASE WHEN claim_type = 'actor' THEN a.actor_id ELSE coalesce(e.event_id, participation_count_id, relation_id) END AS canonical_id
  FROM clm x JOIN gen ON raw_label = x.label LEFT JOIN act a ON claim_type = 'actor' AND a.deal_slug = x.deal_slug AND a.label = replace(x.label, '''', '’')
  LEFT JOIN act f ON f.deal_slug = x.deal_slug AND f.claim_id = x.claim_id AND f.ordinal = 0 AND claim_type = 'actor'
  LEFT JOIN evt e ON e.claim_id = x.claim_id LEFT JOIN cnt n ON n.claim_id = x.claim_id LEFT JOIN rel r ON r.claim_id = x.claim_id)"""
BID = """bdr0 AS (SELECT e.deal_slug, e.cycle_id, a.actor_id, a.label AS actor_label, min(bid_value) AS "bI", min(bid_value_lower) AS "bI_lo", max(bid_value_upper) AS "bI_hi", max(bid_value) AS "bF"
  FROM evt e JOIN lnk2 l USING (event_id) JOIN act a ON a.actor_id = l.actor_id LEFT JOIN gen ON raw_label = a.label
  WHERE event_type = 'bid' AND role IN ('bid_submitter', 'offeror') AND a.observability IN ('named', 'anonymous_handle') AND a.kind IN ('organization', 'person', 'group', 'vehicle') AND NOT coalesce(generic, false) GROUP BY ALL),
bdr AS (SELECT *, row_number() OVER (ORDER BY deal_slug, cycle_id, actor_id) AS n FROM bdr0)"""
BASE = f"WITH {A.CLM}, {LABELLED}"
GRAPH = f"{BASE}, {MEN}, {EVT}, {REL}, {DIS}, {BID} "


def _graph(s, d):
    claims = A.claims(s, d)
    return claims, R.reconcile(claims)


def _stored_graph(s, d):
    """Claims and graph as stored tables, for queries that take many of them."""
    claims = stored(A.claims(s, d), "claims")
    g = R.reconcile(claims, lambda name, df: stored(df, name))
    return claims, g | {name: stored(g[name], name) for name in ("claim_dispositions", "row_evidence")}


def _bidders(g):
    return P.bidder_rows(g["events"], g["event_actor_links"], g["actors"])


def _bids(g):
    return P.bids_of_actors(g["events"], g["event_actor_links"], g["actors"])


def bidder_rows(s, d):
    """Least and greatest bids of each actor: the flagship projection."""
    claims = A.claims(s, d)
    acts, evs = R.actors(claims), R.events(claims)
    return P.bidder_rows(evs, R.event_links(evs, acts), acts).select("bidder_row_id", "projection_name", "deal_slug", "cycle_id", "actor_id", "actor_label", "bI", "bI_lo", "bI_hi", "bF")


def projection_judgments(s, d):
    return P.projection_judgments(_bidders(_graph(s, d)[1])).select("judgment_id", "unit_id", "included", "rule_id", "reason")


def actors(s, d):
    return R.actors(A.claims(s, d)).select("deal_slug", "actor_id", "label", "kind", "observability", "evidence_id")


def actor_dispositions(s, d):
    claims, g = _graph(s, d)
    return g["claim_dispositions"].where("canonical_table = 'actors'").select("claim_id", "disposition", "canonical_id")


def claim_dispositions(s, d):
    return _graph(s, d)[1]["claim_dispositions"].select("disposition_id", "claim_id", "disposition", "reason_code", "canonical_table", "canonical_id")


def canonical_events(s, d):
    return R.events(A.claims(s, d)).select("event_id", "cycle_id", "event_type", "event_subtype", F.date_format("event_date", "yyyy-MM-dd").alias("event_date"), "bid_value", "bid_value_lower", "bid_value_upper", "description", "evidence_id")


def event_actor_links(s, d):
    return _graph(s, d)[1]["event_actor_links"].select("link_id", "event_id", "actor_id", "role", "evidence_id")


def actor_relations(s, d):
    claims = A.claims(s, d)
    return R.relations(claims, R.actors(claims)).select("relation_id", "subject_actor_id", "object_actor_id", "relation_type", "role_detail", "confidence")


def participation_counts(s, d):
    return R.participation_counts(A.claims(s, d)).select("participation_count_id", "process_stage", "actor_class", c("count_min").cast("int").alias("count_min"), c("count_max").cast("int").alias("count_max"))


def row_evidence(s, d):
    return _graph(s, d)[1]["row_evidence"].select("row_table", "row_id", "evidence_id")


def deal_date_bounds(s, d):
    fmt = lambda x: F.date_format(x, "yyyy-MM-dd").alias(x)
    return R.deals(A.claims(s, d)).select("deal_id", "target_label", fmt("start_date"), fmt("end_date"), fmt("announcement_date"))


def claim_values(s, d):
    return A.claims(s, d).select("claim_id", C.raw_value().alias("raw_value"), C.normalized_value().alias("normalized_value"))


def next_sequence(s, d):
    return ids.next_number(A.claims(s, d), "claim_id")


def payload_flatten(s, d):
    """Each user's claims as one JSON payload, parsed and flattened again; every 50th user's is broken or has an unknown key."""
    claims = A.claims(s, d)
    common = [c("claim_type"), F.lit("o").alias("coverage_obligation_id"), "confidence", F.lit("q").alias("quote_text")]
    item = {
        "actor_claims": ("actor", ["actor_label", "actor_kind", "observability"]),
        "event_claims": ("event", ["description"]),
        "bid_claims": ("bid", ["bidder_label", "bid_value", "bid_stage"]),
        "participation_count_claims": ("participation_count", ["process_stage", "count_min"]),
        "actor_relation_claims": ("actor_relation", ["subject_label", "object_label", "relation_type"]),
    }
    arrays = [F.transform(F.array_sort(F.collect_list(F.when(c("claim_type") == kind, F.struct("claim_sequence", F.struct(*common, *fields).alias("x"))))), lambda y: y["x"]).alias(name) for name, (kind, fields) in item.items()]
    made = claims.groupBy("deal_slug").agg(*arrays)
    number = F.substring("deal_slug", 2, 20).cast("long")
    text = F.to_json(F.struct(*item))
    payload = F.when(number % 50 == 7, F.substring(text, 1, 20)).when(number % 50 == 8, F.concat(F.lit('{"other": 1, '), F.substring(text, 2, 1_000_000_000))).otherwise(text)
    parsed = C.parse_payloads(made.select(c("deal_slug").alias("request_id"), payload.alias("payload"))).where("parse_error is null")
    flat = C.flatten(parsed)
    return flat.select("request_id", c("type_order").cast("int").alias("type_order"), c("pos").cast("int").alias("pos"), "claim_type", F.coalesce("actor_label", "description", "bidder_label", "process_stage", "subject_label").alias("main"), "bid_value")


def contract_violations(s, d):
    claims = A.linked_claims(A.claims(s, d))
    return C.violations(claims, A.user_obligations(claims))


def accepted_claims(s, d):
    claims = A.linked_claims(A.claims(s, d))
    bad = C.violations(claims, A.user_obligations(claims))
    return C.accepted(claims, bad).groupBy("deal_slug").agg(F.count("*").alias("n"))


def coverage_results(s, d):
    claims = A.linked_claims(A.claims(s, d))
    return C.coverage_results(A.user_obligations(claims), claims).select("coverage_result_id", "obligation_id", "result", "reason_code", "claim_count")


def generic_label_filter(s, d):
    words = ["six of the potentially interested parties", "Party A", "two", "the 3 bidders", "Private equity firm", "Remaining qualified sponsors", "", "Acme Holdings", "several interested buyers", "strategic"]
    values = s.createDataFrame([(w,) for w in words], "label string")
    labels = A.claims(s, d).select("label").distinct().unionByName(values)
    return labels.select("label", X.is_generic_label(c("label")).alias("generic"))


GENERIC_VALUES = ["six of the potentially interested parties", "Party A", "two", "the 3 bidders", "Private equity firm", "Remaining qualified sponsors", "", "Acme Holdings", "several interested buyers", "strategic"]


def val_claim_disposition(s, d):
    """With defects: every 97th event's disposition is lost, every 89th doubled, every 83rd not current."""
    claims, g = _graph(s, d)
    e = claims.select("claim_id", "event_id")
    ends = g["claim_dispositions"].join(e, "claim_id").where(c("event_id") % 97 != 0)
    ends = ends.withColumn("current", c("event_id") % 83 != 0).withColumn("copy", F.explode(F.when(c("event_id") % 89 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    return Q.exactly_one(claims.select("claim_id"), ends, "claim_id", "claim_disposition", "claims", "disposition")


def val_coverage(s, d):
    claims = A.linked_claims(A.claims(s, d))
    duties = A.user_obligations(claims)
    results = C.coverage_results(duties, claims).withColumn("current", c("claim_count") % 5 != 4)
    return Q.exactly_one(duties.where("current").select("obligation_id"), results, "obligation_id", "coverage_result", "coverage_obligations", "result")


def val_missing_evidence(s, d):
    """Claims and canonical rows whose provenance is lost: that of every 61st event, and of all actors whose id ends in 3."""
    claims, g = _graph(s, d)
    links = claims.where(c("event_id") % 61 != 0).select("claim_id")
    tables = {n: g[n] for n in R.CANONICAL}
    left = g["row_evidence"].where(~((c("row_table") == "actors") & c("row_id").endswith("3")))
    return Q.without(claims.select("claim_id"), links, "claim_id", "claim_evidence", "claims", "claim has no evidence").unionByName(Q.canonical_without_evidence(tables, left))


def val_bid_semantics(s, d):
    return Q.bid_semantics(A.quoted_claims(A.claims(s, d)).where("claim_type = 'bid'"))


def val_relation_semantics(s, d):
    return Q.relation_semantics(A.quoted_claims(A.claims(s, d)).where("claim_type = 'actor_relation'"))


def val_projection_units(s, d):
    rows = _bidders(_graph(s, d)[1])
    units = P.projection_units(rows).where(~c("unit_id").endswith("7"))
    keys = rows.select(F.concat_ws("/", "cycle_id", "actor_id").alias("unit"))
    return Q.without(keys, units.select(F.concat_ws("/", "cycle_id", "actor_id").alias("unit")), "unit", "projection_unit", "bidder_rows", "bidder row has no projection unit")


def constraint_checks(s, d):
    """Keys, references and rules over orders and lineitem."""
    orders, items, customers = (A.table(s, d, n) for n in ("orders", "lineitem", "customer"))
    some = customers.where("c_custkey % 500 <> 3")
    parts = [
        Q.duplicate_keys(items, "lineitem", ["l_orderkey", "l_partkey"]),
        Q.orphans(orders, "orders", "o_orderkey", "o_custkey", some, "c_custkey"),
        Q.broken_rule(orders, "orders", "o_orderkey", c("o_totalprice") >= 2000, "total below 2000"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def soft_flags(s, d):
    judgments = s.createDataFrame([("j1", "projection_eligibility", "p", "a1", False), ("j2", "projection_eligibility", "p", "a2", True), ("j3", "fact_correction", "p", "a3", False)], "judgment_id string, judgment_kind string, projection_name string, actor_id string, included boolean")
    counts = R.participation_counts(A.claims(s, d)).withColumn("anonymous_remainder_count", c("count_min") % 3)
    return Q.soft_flags(judgments, counts)


def _counts(s, d):
    claims, g = _stored_graph(s, d)
    duties = A.user_obligations(claims)
    linked = A.linked_claims(claims)
    results = C.coverage_results(duties, linked)
    return claims, linked, g, duties, results


def proof_row_counts(s, d):
    claims, _, g, duties, results = _counts(s, d)
    names = ["claim_dispositions", "deals", "actors", "actor_relations", "events", "event_actor_links", "participation_counts"]
    return P.row_counts({"claims": claims, "coverage_obligations": duties, "coverage_results": results, **{n: g[n] for n in names}, "bidder_rows": _bids(g)})


def proof_verdict(s, d):
    claims, linked, g, duties, results = _counts(s, d)
    failures = Q.exactly_one(claims.select("claim_id"), g["claim_dispositions"], "claim_id", "claim_disposition", "claims", "disposition")
    return P.proof(P.facts(claims, duties, results, g["claim_dispositions"], {n: g[n] for n in R.CANONICAL}, g["row_evidence"], _bids(g), failures))


def group_counts(s, d):
    claims, linked, g, duties, results = _counts(s, d)
    part = lambda df, col: P.group_counts(df, col).select(F.lit(col).alias("grouping"), "value", "n")
    return part(claims, "claim_type").unionByName(part(g["claim_dispositions"], "disposition")).unionByName(part(results, "result")).orderBy("grouping", "value")


def deal_summaries(s, d):
    claims, g = _stored_graph(s, d)
    return P.deal_summaries(g["deals"], {"claims": claims, "actors": g["actors"], "events": g["events"], "event_actor_links": g["event_actor_links"], "actor_relations": g["actor_relations"], "participation_counts": g["participation_counts"], "bidder_rows": _bids(g)})


def coverage_export(s, d):
    claims = A.claims(s, d)
    duties = A.user_obligations(claims)
    results = C.coverage_results(duties, A.linked_claims(claims))
    return P.coverage_export(duties, results.where(~c("obligation_id").endswith("_2")))


def disposition_export(s, d):
    claims, g = _graph(s, d)
    return P.disposition_export(claims, g["claim_dispositions"].where("disposition <> 'rejected'"))


def deal_cost_metrics(s, d):
    claims, g = _graph(s, d)
    ends = g["claim_dispositions"].withColumn("reason_code", F.when(c("disposition") == "rejected", "quote_rejected").otherwise(c("reason_code")))
    return P.deal_cost_metrics(A.cost_records(s, d), claims, ends)


def cost_envelope(s, d):
    """Three deals, two of them with a known cost; prices for a million tokens."""
    m = deal_cost_metrics(s, d).where("deal_slug in ('u1', 'u2', 'u3')").withColumn("cost_usd", F.when(c("deal_slug") != "u3", F.lit(1.5)))
    return P.cost_envelope(m, 3.0, 15.0)


def latency_percentiles(s, d):
    return P.percentiles(A.cost_records(s, d).withColumn("seconds", c("latency_ms") / 1000), ["deal_slug"], "seconds")


def gap_cycles(s, d):
    got = Y.gap_cycles(A.dated_rows(s, d), 1)
    return got.select("slug", "sequence", F.date_format("start_date", "yyyy-MM-dd").alias("start_date"), F.date_format("end_date", "yyyy-MM-dd").alias("end_date"), "first_char", "last_char", "first_evidence", "last_evidence")


def cycle_assignment(s, d):
    """Rows are assigned to the cycles of the even events only, so that some lie in none."""
    rows = A.dated_rows(s, d)
    return Y.assign_cycles(rows, Y.gap_cycles(rows.where(c("candidate_id").cast("long") % 6 == 0), 1))


def boundary_pick(s, d):
    rows = A.claims(s, d).select("deal_slug", c("claim_id").alias("candidate_id"), "claim_sequence", _boundary_quote().alias("quote_text"))
    return Y.boundaries(rows, ["deal_slug"], ["claim_sequence"])


def _boundary_quote():
    k = c("k")
    return F.when(k % 11 == 0, "They granted Exclusivity").when(k % 11 == 1, "It submitted a first round bid").when(k % 11 == 2, "submitted an indication of interest").when((k % 11 == 3) & (c("claim_sequence") % 9 == 0), "were invited to submit final offers").otherwise("nothing")


def latest_judgments(s, d):
    """Orders as judgments, each superseding the order before it if its key is even."""
    orders = A.table(s, d, "orders")
    rows = orders.select(c("o_orderkey").alias("judgment_id"), F.when(c("o_orderkey") % 2 == 0, c("o_orderkey") - 1).alias("supersedes_judgment_id"))
    return Y.latest_judgments(rows)


def shard_plan(s, d):
    return P.shard_plan(A.claims(s, d).select("deal_slug"), 7)


def run_clock(s, d):
    users = A.table(s, d, "events").select(c("user_id").cast("string").alias("u")).distinct()
    return users.select("u", X.clock_offset(X.sha256(c("u")), F.lit("run"), F.lit(3)).alias("offset_s"))


QUERIES = {
    f.__name__: f
    for f in (
        bidder_rows, projection_judgments, actors, actor_dispositions, claim_dispositions, canonical_events, event_actor_links, actor_relations, participation_counts, row_evidence, deal_date_bounds,
        claim_values, next_sequence, payload_flatten, contract_violations, accepted_claims, coverage_results, generic_label_filter, val_claim_disposition, val_coverage, val_missing_evidence,
        val_bid_semantics, val_relation_semantics, val_projection_units, constraint_checks, soft_flags, proof_row_counts, proof_verdict, group_counts, deal_summaries, coverage_export, disposition_export,
        deal_cost_metrics, cost_envelope, latency_percentiles, gap_cycles, cycle_assignment, boundary_pick, latest_judgments, shard_plan, run_clock,
    )
}

LINKED = f"{BASE}, {A.OBL}, {A.LNK}"
RES = "res AS (SELECT obligation_id, o.deal_slug, n, expected_claim_type, importance, obligation_label, CAST((SELECT count(*) FROM lnk WHERE coverage_obligation_id = obligation_id) AS INTEGER) AS claim_count FROM obl o)"
RESULT = "CASE WHEN claim_count > 0 THEN 'claims_emitted' ELSE 'missed' END"
REASON = "CASE WHEN claim_count > 0 THEN 'claims_linked' ELSE 'no_linked_claim' END"
FULL = f"{BASE}, {A.OBL}, {A.LNK}, {RES}, {MEN}, {EVT}, {REL}, {DIS}, {BID} "
_STRIP = "regexp_replace(regexp_replace({0}, '0+$', ''), '\\.$', '')"


def _norm(x: str) -> str:
    return f"trim(regexp_replace(translate(lower({x}), '-_', '  '), '\\s+', ' ', 'g'))"


def _number(v: str) -> str:
    """A value's support by the quote, in DuckDB; the values here have few digits, so one more form covers them."""
    forms = ", ".join(_STRIP.format(f) for f in (f"printf('%.1f', {v})", f"printf('%.2f', {v})", f"CAST({v} AS VARCHAR)"))
    return f"coalesce(list_has_any([{forms}], list_transform(regexp_extract_all(quote_text, '[0-9]+(?:\\.[0-9]+)?'), lambda x: {_STRIP.format('x')})) OR list_contains(list_transform(regexp_extract_all(quote_text, '[0-9]+'), lambda x: CASE WHEN ltrim(x, '0') = '' THEN '0' ELSE ltrim(x, '0') END), CAST(CAST(trunc({v}) AS BIGINT) AS VARCHAR)), false)"


_TOKENS = "list_transform(regexp_extract_all(quote_text, '[0-9]+'), lambda x: CASE WHEN ltrim(x, '0') = '' THEN '0' ELSE ltrim(x, '0') END)"
_DATE = f"(contains(lower(quote_text), strftime(day, '%Y-%m-%d')) OR (contains(quote_text, CAST(year(day) AS VARCHAR)) AND (contains(lower(quote_text), lower(strftime(day, '%B'))) OR contains(lower(quote_text), lower(strftime(day, '%b'))) OR list_contains({_TOKENS}, CAST(month(day) AS VARCHAR))) AND list_contains({_TOKENS}, CAST(day(day) AS VARCHAR))))"
_BIDTERMS = " OR ".join(f"contains({_norm('quote_text')}, '{t}')" for t in V.BID_TERMS)
_RELTERMS = " OR ".join("(relation_type = '" + r + "' AND (" + " OR ".join(f"contains({_norm('quote_text')}, '{p}')" for p in ps) + "))" for r, ps in V.RELATION_PHRASES.items())
_LACK = "array_to_string(list_filter([{0}], lambda x: x IS NOT NULL), ', ')"
_BOUND = "CASE WHEN k % 11 = 0 THEN 'exclusivity_grant' WHEN k % 11 = 1 THEN 'first_round_bid' WHEN k % 11 = 2 THEN 'ioi_submitted' WHEN k % 11 = 3 AND claim_sequence % 9 = 0 THEN 'advancement_admitted' END"
COSTED = f"""{FULL}, {A.COST},
ends AS (SELECT deal_slug, count(*) FILTER (disposition = 'canonicalized') AS canonicalized, count(*) FILTER (disposition = 'merged_duplicate') AS merged_duplicate, count(*) FILTER (disposition = 'rejected') AS rejected FROM dis GROUP BY 1),
src AS (SELECT deal_slug, count(*) AS windows, CAST(sum(coalesce(input_tokens, 0)) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens, CAST(sum(coalesce(retry_count, 0)) AS BIGINT) AS retry_count,
  count(*) FILTER (provider_failure <> '') AS provider_failure_count, max(latency_ms / 1000) AS max_latency_s, CASE WHEN count(DISTINCT token_source) = 2 THEN 'mixed' ELSE max(token_source) END AS token_usage_basis FROM cost GROUP BY 1),
met AS (SELECT src.*, (SELECT count(*) FROM clm WHERE clm.deal_slug = src.deal_slug) AS claims, canonicalized, merged_duplicate, rejected, rejected AS quote_rejections FROM src JOIN ends USING (deal_slug))"""
CYC = """cyc0 AS (SELECT *, CASE WHEN event_date - lag(event_date) OVER w > 1 THEN 1 ELSE 0 END AS opens FROM {src} WHERE event_date IS NOT NULL WINDOW w AS (PARTITION BY slug ORDER BY event_date, char_start, candidate_id)),
cyc1 AS (SELECT *, CAST(sum(opens) OVER (PARTITION BY slug ORDER BY event_date, char_start, candidate_id ROWS UNBOUNDED PRECEDING) + 1 AS INTEGER) AS sequence FROM cyc0),
cyc AS (SELECT slug, sequence, min(event_date) AS start_date, max(event_date) AS end_date, min(char_start) AS first_char, max(char_end) AS last_char,
  first(evidence_id ORDER BY event_date, char_start, candidate_id) AS first_evidence, last(evidence_id ORDER BY event_date, char_start, candidate_id) AS last_evidence FROM cyc1 GROUP BY slug, sequence)"""
_CANON = " UNION ALL ".join(
    [
        "SELECT 'deals' AS row_table, deal_slug || '_deal_1' AS row_id, evidence_id FROM men WHERE claim_id = ''",
        "SELECT 'process_cycles', deal_slug || '_cycle_1', evidence_id FROM men WHERE claim_id = ''",
        "SELECT 'actors', actor_id, evidence_id FROM act",
        "SELECT 'actor_relations', relation_id, evidence_id FROM rel",
        "SELECT 'events', event_id, evidence_id FROM evt",
        "SELECT 'event_actor_links', link_id, evidence_id FROM lnk2",
        "SELECT 'participation_counts', participation_count_id, evidence_id FROM cnt",
    ]
)
ORACLE_SQL = {
    "bidder_rows": GRAPH + f"""SELECT 'bidderrow_' || n AS bidder_row_id, '{V.PROJECTION_NAME}' AS projection_name, deal_slug, cycle_id, actor_id, actor_label, "bI", "bI_lo", "bI_hi", "bF" FROM bdr""",
    "projection_judgments": GRAPH + f"SELECT 'projectionjudgment_' || n AS judgment_id, 'projectionunit_' || n AS unit_id, true AS included, '{V.PROJECTION_RULE}' AS rule_id, 'source-backed bid in cycle' AS reason FROM bdr",
    "actors": GRAPH + "SELECT deal_slug, actor_id, label, kind, observability, evidence_id FROM act",
    "actor_dispositions": GRAPH + "SELECT claim_id, disposition, canonical_id FROM dis WHERE claim_type = 'actor'",
    "claim_dispositions": GRAPH + "SELECT disposition_id, claim_id, disposition, reason_code, canonical_table, canonical_id FROM dis",
    "canonical_events": GRAPH + "SELECT event_id, cycle_id, event_type, event_subtype, strftime(event_date, '%Y-%m-%d') AS event_date, bid_value, bid_value_lower, bid_value_upper, description, evidence_id FROM evt",
    "event_actor_links": GRAPH + "SELECT link_id, event_id, actor_id, role, evidence_id FROM lnk2",
    "actor_relations": GRAPH + "SELECT relation_id, subject_actor_id, object_actor_id, relation_type, role_detail, confidence FROM rel",
    "participation_counts": GRAPH + "SELECT participation_count_id, process_stage, actor_class, count_min, count_max FROM cnt",
    "row_evidence": GRAPH + _CANON,
    "deal_date_bounds": BASE + ", b AS (SELECT deal_slug, min(CASE WHEN claim_type IN ('event', 'bid') THEN day END) AS a, max(CASE WHEN claim_type IN ('event', 'bid') THEN day END) AS z FROM clm GROUP BY 1) SELECT deal_slug || '_deal_1' AS deal_id, upper(deal_slug[1]) || deal_slug[2:] AS target_label, strftime(a, '%Y-%m-%d') AS start_date, strftime(z, '%Y-%m-%d') AS end_date, strftime(z, '%Y-%m-%d') AS announcement_date FROM b",
    "claim_values": BASE + " SELECT claim_id, CASE claim_type WHEN 'actor' THEN label WHEN 'event' THEN description WHEN 'bid' THEN label || ':' || coalesce(CAST(coalesce(bid_value, bid_value_lower) AS VARCHAR), 'None') WHEN 'participation_count' THEN process_stage || ':' || actor_class || ':' || count_min ELSE label || ':' || relation_type || ':' || label2 END AS raw_value, CASE claim_type WHEN 'event' THEN strftime(day, '%Y-%m-%d') WHEN 'bid' THEN CASE WHEN bid_value IS NOT NULL THEN CAST(bid_value AS VARCHAR) WHEN bid_value_lower IS NOT NULL OR bid_value_upper IS NOT NULL THEN coalesce(CAST(bid_value_lower AS VARCHAR), 'None') || '-' || coalesce(CAST(bid_value_upper AS VARCHAR), 'None') END WHEN 'participation_count' THEN CAST(count_min AS VARCHAR) END AS normalized_value FROM clm",
    "next_sequence": BASE + " SELECT deal_slug, CAST(max(CAST(regexp_extract(claim_id, '_([0-9]+)$', 1) AS INTEGER)) + 1 AS INTEGER) AS next_n FROM clm GROUP BY 1",
    "payload_flatten": BASE + ", o AS (SELECT deal_slug AS request_id, CASE claim_type WHEN 'actor' THEN 0 WHEN 'event' THEN 1 WHEN 'bid' THEN 2 WHEN 'participation_count' THEN 3 ELSE 4 END AS type_order, * FROM clm WHERE CAST(deal_slug[2:] AS INTEGER) % 50 NOT IN (7, 8)) SELECT request_id, CAST(type_order AS INTEGER) AS type_order, CAST(row_number() OVER (PARTITION BY request_id, type_order ORDER BY claim_sequence) - 1 AS INTEGER) AS pos, claim_type, CASE type_order WHEN 1 THEN description WHEN 3 THEN process_stage ELSE label END AS main, CASE WHEN type_order = 2 THEN bid_value END AS bid_value FROM o",
    "contract_violations": LINKED + " SELECT l.deal_slug, claim_id, CASE WHEN obligation_id IS NULL THEN 'unknown_obligation' ELSE 'obligation_of_other_type' END AS violation FROM lnk l LEFT JOIN obl ON coverage_obligation_id = obligation_id WHERE obligation_id IS NULL OR expected_claim_type <> claim_type",
    "accepted_claims": LINKED + " SELECT deal_slug, count(*) AS n FROM lnk WHERE deal_slug NOT IN (SELECT l.deal_slug FROM lnk l LEFT JOIN obl ON coverage_obligation_id = obligation_id WHERE obligation_id IS NULL OR expected_claim_type <> claim_type) GROUP BY 1",
    "coverage_results": LINKED + f", {RES} SELECT deal_slug || '_coverage_' || n AS coverage_result_id, obligation_id, {RESULT} AS result, {REASON} AS reason_code, claim_count FROM res",
    "generic_label_filter": BASE + ", v(label) AS (SELECT DISTINCT label FROM clm UNION ALL VALUES " + ", ".join(f"('{w}')" for w in GENERIC_VALUES) + f") SELECT label, {_generic('label')} AS generic FROM v",
    "val_claim_disposition": BASE + ", x AS (SELECT claim_id, CASE WHEN event_id % 97 = 0 OR event_id % 83 = 0 THEN 0 WHEN event_id % 89 = 0 THEN 2 ELSE 1 END AS n FROM clm) SELECT 'claim_disposition' AS check_name, 'claims' AS table_name, claim_id AS row_id, 'current disposition count is ' || n AS detail FROM x WHERE n <> 1",
    "val_coverage": LINKED + f", {RES} SELECT 'coverage_result' AS check_name, 'coverage_obligations' AS table_name, obligation_id AS row_id, 'current result count is 0' AS detail FROM res WHERE claim_count % 5 = 4",
    "val_missing_evidence": GRAPH + f", can AS ({_CANON}) SELECT 'claim_evidence' AS check_name, 'claims' AS table_name, claim_id AS row_id, 'claim has no evidence' AS detail FROM clm WHERE event_id % 61 = 0 UNION ALL SELECT 'row_evidence', row_table, row_id, 'canonical row has no relational row_evidence' FROM can WHERE row_table = 'actors' AND row_id LIKE '%3'",
    "val_bid_semantics": BASE + f", {A.QUO}, x AS (SELECT claim_id, " + _LACK.format(f"CASE WHEN NOT contains({_norm('quote_text')}, {_norm('label')}) THEN 'bidder_label' END, CASE WHEN NOT {_DATE} THEN 'bid_date' END, CASE WHEN NOT ({_number('bid_value')} OR {_number('bid_value_lower')} OR {_number('bid_value_upper')}) THEN 'bid_value' END, CASE WHEN NOT ({_BIDTERMS} OR (bid_stage <> 'unspecified' AND contains({_norm('quote_text')}, bid_stage))) THEN 'bid_context' END") + " AS lack FROM quo WHERE claim_type = 'bid') SELECT 'semantic_claim_evidence' AS check_name, 'bid_claims' AS table_name, claim_id AS row_id, 'quote does not support ' || lack AS detail FROM x WHERE lack <> ''",
    "val_relation_semantics": BASE + f", {A.QUO}, x AS (SELECT claim_id, " + _LACK.format(f"CASE WHEN NOT contains({_norm('quote_text')}, {_norm('label')}) THEN 'subject_label' END, CASE WHEN NOT contains({_norm('quote_text')}, {_norm('label2')}) THEN 'object_label' END, CASE WHEN NOT (contains({_norm('quote_text')}, replace(relation_type, '_', ' ')) OR coalesce(contains({_norm('quote_text')}, role_detail), false) OR {_RELTERMS}) THEN 'relation_type' END") + " AS lack FROM quo WHERE claim_type = 'actor_relation') SELECT 'semantic_claim_evidence' AS check_name, 'actor_relation_claims' AS table_name, claim_id AS row_id, 'quote does not support ' || lack AS detail FROM x WHERE lack <> ''",
    "val_projection_units": GRAPH + "SELECT 'projection_unit' AS check_name, 'bidder_rows' AS table_name, cycle_id || '/' || actor_id AS row_id, 'bidder row has no projection unit' AS detail FROM bdr WHERE n % 10 = 7",
    "constraint_checks": "SELECT 'unique' AS check_name, 'lineitem' AS table_name, l_orderkey || '/' || l_partkey AS row_id, count(*) || ' rows share the key' AS detail FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1 UNION ALL SELECT 'reference', 'orders', CAST(o_orderkey AS VARCHAR), 'o_custkey ' || o_custkey || ' has no parent' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 500 <> 3) UNION ALL SELECT 'check', 'orders', CAST(o_orderkey AS VARCHAR), 'total below 2000' FROM orders WHERE o_totalprice < 2000",
    "soft_flags": GRAPH + "SELECT 'projection_exclusion' AS flag_type, 'judgments' AS table_name, 'j1' AS row_id, 'p excludes actor_id=a1' AS detail UNION ALL SELECT 'count_only_cohort', 'participation_counts', participation_count_id, (count_min % 3) || ' anonymous participant(s) remain aggregate only' FROM cnt WHERE count_min % 3 <> 0",
    "proof_row_counts": FULL + " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {t}" for n, t in (("claims", "clm"), ("coverage_obligations", "obl"), ("coverage_results", "res"), ("claim_dispositions", "dis"), ("deals", "slugs"), ("actors", "act"), ("actor_relations", "rel"), ("events", "evt"), ("event_actor_links", "lnk2"), ("participation_counts", "cnt"), ("bidder_rows", "bdr"))),
    "proof_verdict": FULL + ", p AS (SELECT (SELECT count(*) FROM clm) AS live_claims, (SELECT count(*) FROM obl) AS obligations, (SELECT count(*) FROM res WHERE claim_count = 0) AS insufficient, CAST(0 AS BIGINT) AS undisposed, CAST(0 AS BIGINT) AS unevidenced, (SELECT count(*) FROM bdr) AS bidder_rows, (SELECT count(*) FROM act) AS actors, (SELECT count(*) FROM evt) AS events, (SELECT count(*) FROM clm x WHERE (SELECT count(*) FROM dis WHERE dis.claim_id = x.claim_id) <> 1) AS failures) SELECT *, CASE WHEN bidder_rows = 0 OR actors = 0 OR events = 0 THEN 'BLOCKED' WHEN failures > 0 THEN 'UNSOUND' WHEN live_claims = 0 OR insufficient > 0 OR undisposed > 0 OR unevidenced > 0 OR live_claims < greatest(1, obligations // 3) THEN 'SUSPECT' ELSE 'SOUND' END AS verdict FROM p",
    "group_counts": FULL + f"SELECT 'claim_type' AS grouping, claim_type AS value, count(*) AS n FROM clm GROUP BY 2 UNION ALL SELECT 'disposition', disposition, count(*) FROM dis GROUP BY 2 UNION ALL SELECT 'result', {RESULT}, count(*) FROM res GROUP BY 2",
    "deal_summaries": FULL + "SELECT deal_slug, " + ", ".join(f"(SELECT count(*) FROM {t} WHERE {t}.deal_slug = slugs.deal_slug) AS {n}" for n, t in (("claims", "clm"), ("actors", "act"), ("events", "evt"), ("event_actor_links", "lnk2"), ("actor_relations", "rel"), ("participation_counts", "cnt"), ("bidder_rows", "bdr"))) + " FROM slugs",
    "coverage_export": LINKED + f", {RES} SELECT deal_slug, obligation_id, expected_claim_type, importance, CASE WHEN n <> 2 THEN {RESULT} END AS result, CASE WHEN n <> 2 THEN claim_count END AS claim_count, CASE WHEN n <> 2 THEN {REASON} END AS reason_code FROM res",
    "disposition_export": GRAPH + "SELECT x.deal_slug, x.claim_id, x.claim_type, disposition, canonical_table, canonical_id, reason_code FROM clm x LEFT JOIN (SELECT * FROM dis WHERE disposition <> 'rejected') d ON d.claim_id = x.claim_id",
    "deal_cost_metrics": COSTED + " SELECT * FROM met",
    "cost_envelope": COSTED + ", t AS (SELECT count(*) AS deals, sum(windows) AS w, sum(input_tokens) AS i, sum(output_tokens) AS o, sum(claims) AS c, sum(retry_count) AS r, sum(provider_failure_count) AS f, sum(quote_rejections) AS q, CASE WHEN count(DISTINCT token_usage_basis) = 1 AND max(token_usage_basis) IN ('actual', 'estimated') THEN max(token_usage_basis) ELSE 'mixed' END AS basis FROM met WHERE deal_slug IN ('u1', 'u2', 'u3')), n(deal_count) AS (VALUES (3), (9), (30), (400), (800)) SELECT CAST(deal_count AS INTEGER) AS deal_count, basis AS cost_basis, " + ", ".join(f"CAST({x} AS DOUBLE) * (deal_count / deals) AS projected_{name}" for x, name in (("w", "windows"), ("i", "input_tokens"), ("o", "output_tokens"), ("c", "claims"), ("r", "retry_count"), ("f", "provider_failure_count"), ("q", "quote_rejections"))) + ", (CAST(i AS DOUBLE) * (deal_count / deals) * 3.0::DOUBLE + CAST(o AS DOUBLE) * (deal_count / deals) * 15.0::DOUBLE) / 1000000 AS estimated_cost_usd, CAST(NULL AS DOUBLE) AS actual_cost_usd, 3.0::DOUBLE AS partial_actual_cost_usd, CASE WHEN c > 0 THEN q / c ELSE 0.0 END::DOUBLE AS quote_rejection_rate FROM t, n",
    "latency_percentiles": f"WITH {A.COST} SELECT deal_slug, quantile_cont(latency_ms / 1000, 0.5) AS p50, quantile_disc(latency_ms / 1000, 0.95) AS p95, max(latency_ms / 1000) AS max FROM cost GROUP BY 1",
    "gap_cycles": f"WITH {A.DAT}, " + CYC.format(src="dat") + " SELECT slug, sequence, strftime(start_date, '%Y-%m-%d') AS start_date, strftime(end_date, '%Y-%m-%d') AS end_date, first_char, last_char, first_evidence, last_evidence FROM cyc",
    "cycle_assignment": f"WITH {A.DAT}, six AS (SELECT * FROM dat WHERE CAST(candidate_id AS BIGINT) % 6 = 0), " + CYC.format(src="six") + ", p AS (SELECT d.candidate_id, sequence, CASE WHEN event_date IS NOT NULL THEN event_date BETWEEN start_date AND end_date ELSE char_start BETWEEN first_char AND last_char END AS inside, CASE WHEN event_date IS NOT NULL THEN abs(start_date - event_date) ELSE abs(first_char - char_start) END AS away FROM dat d LEFT JOIN cyc USING (slug)) SELECT candidate_id, first(sequence ORDER BY CASE WHEN inside THEN 0 ELSE 1 END, CASE WHEN inside THEN 0 ELSE away END, sequence) AS sequence FROM p GROUP BY 1",
    "boundary_pick": BASE + f", x AS (SELECT deal_slug, claim_id, claim_sequence, {_BOUND} AS subtype FROM clm), y AS (SELECT *, CASE subtype WHEN 'advancement_admitted' THEN 1 WHEN 'exclusivity_grant' THEN 2 WHEN 'ioi_submitted' THEN 4 ELSE 5 END AS rank FROM x WHERE subtype IS NOT NULL) SELECT deal_slug, first(subtype ORDER BY rank, claim_sequence) AS subtype, first(claim_id ORDER BY rank, claim_sequence) AS candidate_id FROM y GROUP BY 1",
    "latest_judgments": "SELECT o_orderkey AS judgment_id, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey - 1 END AS supersedes_judgment_id FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey - 1 FROM orders WHERE o_orderkey % 2 = 0)",
    "shard_plan": f"{BASE}, s AS (SELECT DISTINCT deal_slug FROM clm), r AS (SELECT deal_slug, CAST(row_number() OVER (ORDER BY deal_slug) AS INTEGER) AS source_order FROM s) SELECT deal_slug, source_order, 'shard-' || lpad(CAST((source_order - 1) // 7 + 1 AS VARCHAR), 4, '0') AS shard_id FROM r",
    "run_clock": "SELECT DISTINCT CAST(user_id AS VARCHAR) AS u, CAST('0x' || substr(sha256(sha256(CAST(user_id AS VARCHAR)) || chr(0) || 'run' || chr(0) || '3'), 1, 8) AS BIGINT) % 86400 AS offset_s FROM events",
}

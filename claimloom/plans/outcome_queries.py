"""Queries over provider attempts, ledgers, validation outputs, cost rows and request schemas made of the events."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from claimloom.functions import vocabulary as V
from claimloom.operators import contract as K
from claimloom.operators import outcomes as O
from claimloom.operators import project as P
from claimloom.plans import adaptors as A
from claimloom.plans import claim_queries as Q

c = F.col

# Attempts: three events in a row are those of one request; how each went follows from its number.
ATT = """att AS (
  SELECT 'r' || (event_id // 3) AS request_id, event_id // 3 AS r, CAST(event_id % 3 + 1 AS INTEGER) AS attempt, (event_id * 7 + event_id // 3) % 12 AS k, 'm' || event_id AS message, event_id % 5000 AS latency_ms FROM events),
atk AS (SELECT *, CASE k WHEN 5 THEN 429 WHEN 6 THEN 503 WHEN 7 THEN 400 WHEN 10 THEN 404 WHEN 11 THEN 200 END AS status,
  CASE k WHEN 5 THEN 'RateLimitError' WHEN 6 THEN 'InternalServerError' WHEN 7 THEN 'BadRequestError' WHEN 8 THEN 'TimeoutError' WHEN 9 THEN 'LLMContractError' WHEN 10 THEN 'APIError' WHEN 11 THEN 'APIConnectionError' END AS error_type, CASE WHEN k = 10 THEN 'stream_read_error' END AS error_code FROM att)"""


def attempts(s, d):
    e = c("event_id")
    k = (e * 7 + F.floor(e / 3)) % 12
    pick = lambda **of: F.coalesce(*(F.when(k == int(n[1:]), v) for n, v in of.items()))
    return A.table(s, d, "events").select(
        F.concat(F.lit("r"), F.floor(e / 3).cast("string")).alias("request_id"), (e % 3 + 1).cast("int").alias("attempt"), pick(k5=429, k6=503, k7=400, k10=404, k11=200).alias("status"),
        pick(k5="RateLimitError", k6="InternalServerError", k7="BadRequestError", k8="TimeoutError", k9="LLMContractError", k10="APIError", k11="APIConnectionError").alias("error_type"),
        F.when(k == 10, "stream_read_error").alias("error_code"), F.concat(F.lit("m"), e.cast("string")).alias("message"), (e % 5000).alias("latency_ms"),
    )


def provider_outcomes(s, d):
    """Every third request of ten has faults of its payload, some more than are shown."""
    requests = A.table(s, d, "events").select(F.floor(c("event_id") / 3).alias("r")).distinct().where("r % 10 = 3")
    faults = requests.select(F.concat(F.lit("r"), c("r").cast("string")).alias("request_id"), F.lit("bid_claims").alias("claim_array"), F.explode(F.sequence(F.lit(1), (c("r") % 40 + 1).cast("int"))).alias("pos"), F.lit("bad sk-secret1").alias("fault"))
    return O.provider_outcomes(attempts(s, d), faults).withColumn("shown", F.array_join("shown", "|"))


def _records(s, d):
    e = c("event_id")
    return A.cost_records(s, d).withColumns({"run_id": F.lit("run"), "window_id": F.concat_ws("_", "deal_slug", F.lit("window"), e.cast("string")), "provider": F.lit("p"), "model": F.when(e % 2 == 0, "m0").otherwise("m1"), "reasoning_effort": F.when(e % 3 == 0, "high").otherwise("medium")})


def usage_ledger(s, d):
    return O.usage_ledger(_records(s, d))


def latency_ledger(s, d):
    return O.latency_ledger(_records(s, d))


def disposition_mix(s, d):
    """The dispositions of all deals, merged from the deals' own maps."""
    per_deal = O.disposition_counts(Q._graph(s, d)[1]["claim_dispositions"])
    return O.merged_counts(per_deal, "disposition_counts").select(F.to_json("disposition_counts").alias("mix"))


def _failures(s, d):
    return O.union([Q.val_claim_disposition(s, d), Q.val_coverage(s, d), Q.val_relation_semantics(s, d)])


def ambiguity_queue(s, d):
    return O.ambiguity_queue(_failures(s, d))


def validation_report(s, d):
    return O.validation_report(_failures(s, d)).select("passed", "hard_failures", F.to_json("by_check").alias("by_check"))


def cost_summary_rows(s, d):
    """Of three deals, which can be projected, and of all deals, which can't."""
    m = Q.deal_cost_metrics(s, d).withColumn("cost_usd", F.when(c("deal_slug") != "u3", F.lit(1.5))).withColumn("coverage_obligations", F.lit(len(V.OBLIGATIONS)))
    of = lambda name, df: P.cost_rows(df, 3.0, 15.0).withColumn("deals_of", F.lit(name))
    return of("three", m.where("deal_slug in ('u1', 'u2', 'u3')")).unionByName(of("all", m))


def candidate_metrics(s, d):
    """Events as calibration jobs of a stage and candidate."""
    e = c("event_id")
    rows = A.table(s, d, "events").select(c("event_type").alias("stage"), F.concat(F.lit("c"), (e % 4).cast("string")).alias("candidate"), F.when(e % 9 != 0, "OK").alias("result"), F.round(c("value"), 2).alias("duration_s"), F.when(e % 5 != 0, e % 997).alias("input_tokens"), (e % 101).alias("output_tokens"), F.when(e % 3 != 0, (e % 100) / 100).alias("quote_match_rate"), F.when(e % 7 != 0, e % 50).alias("strict_claims"))
    return P.candidate_metrics(rows)


def request_schemas(s, d):
    """The schema of each user's request, whose obligations are some of the fixed ones."""
    claims = A.claims(s, d).select("deal_slug").distinct()
    n = F.substring("deal_slug", 2, 20).cast("long") % 4
    rows = A.user_obligations(claims).withColumn("k", F.regexp_extract("obligation_id", "_([0-9]+)$", 1).cast("int")).where((n == 0) | (n == 1) & c("expected_claim_type").isin("bid", "event") | (n == 2) & (c("k") % 2 == 0) | (n == 3) & (c("obligation_label") != "Final bid price"))
    held = rows.groupBy("deal_slug").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "obligation_id", "expected_claim_type", "obligation_label"))), lambda o: o.dropFields("k")).alias("obligations"))
    return held.select("deal_slug", F.sha2(K.schema_of(c("obligations")), 256).alias("schema_sha256"))


QUERIES = {f.__name__: f for f in (provider_outcomes, usage_ledger, latency_ledger, disposition_mix, ambiguity_queue, validation_report, cost_summary_rows, candidate_metrics, request_schemas)}

_LIST = lambda values: "'" + json.dumps(values, separators=(",", ":")) + "'"


def _schema_sql() -> str:
    """A template with names in place of lists, and the lists as DuckDB makes them of a deal's obligations."""
    names = {(a, "coverage_obligation_id"): f"@ids {a}@" for a in K.FIELDS} | {where[:2]: f"@narrow {kind}@" for (kind, _), where in K.NARROWED.items()}
    text = "'" + K.request_schema(names).replace("'", "''") + "'"
    for (array, field), mark in names.items():
        kind = array.removesuffix("_claims")
        if field == "coverage_obligation_id":
            made = f"coalesce('[\"' || string_agg(obligation_id, '\",\"' ORDER BY n) FILTER (expected_claim_type = '{kind}') || '\"]', '[\"__no_{kind}_coverage_obligation__\"]')"
        else:
            label, values = next((lab, w[2]) for (k, lab), w in K.NARROWED.items() if k == kind)
            made = f"CASE WHEN coalesce(bool_and(obligation_label = '{label}') FILTER (expected_claim_type = '{kind}'), false) THEN {_LIST(values)} ELSE {_LIST(K.FIELDS[array][field].kind)} END"
        text = f"replace({text}, '{json.dumps(mark)}', {made})"
    return text


_REFUSED = "error_type IS NOT NULL AND (error_type = 'LLMContractError' OR NOT (coalesce(error_type = 'TimeoutError', false) OR coalesce(error_code = 'stream_read_error', false) OR CASE WHEN status IS NOT NULL THEN status IN (408, 409, 425, 429) OR status >= 500 ELSE error_type IN ('APIConnectionError') END))"
_FAILED = f"({Q.ORACLE_SQL['val_claim_disposition']}), f2 AS ({Q.ORACLE_SQL['val_coverage']}), f3 AS ({Q.ORACLE_SQL['val_relation_semantics']}), f AS (SELECT * FROM f1 UNION ALL SELECT * FROM f2 UNION ALL SELECT * FROM f3)"
_ROWS = "CAST({w} AS DOUBLE)"
ORACLE_SQL = {
    "provider_outcomes": f"""WITH {ATT}, g AS (SELECT *, error_type IS NULL OR attempt >= 3 OR ({_REFUSED}) AS ends FROM atk),
      h AS (SELECT * FROM g x WHERE NOT EXISTS (SELECT 1 FROM g y WHERE y.r = x.r AND y.attempt < x.attempt AND y.ends)),
      a AS (SELECT request_id, r, bool_or(ends) AS ends, CAST(count(*) AS INTEGER) AS attempts, CAST(sum(latency_ms) AS BIGINT) AS latency_ms, arg_max(status, attempt) FILTER (status IS NOT NULL) AS x, max(attempt) AS last FROM h GROUP BY request_id, r),
      z AS (SELECT a.*, h.status AS http_status, h.error_type, h.message, CASE WHEN a.r % 10 = 3 THEN a.r % 40 + 1 ELSE 0 END AS faults FROM a JOIN h ON h.r = a.r AND h.attempt = a.last)
      SELECT request_id, CASE WHEN NOT ends THEN 'pending' WHEN error_type IS NULL THEN CASE WHEN faults > 0 THEN 'contract_invalid' ELSE 'completed' END WHEN error_type = 'LLMContractError' THEN 'contract_invalid' WHEN http_status BETWEEN 400 AND 499 AND http_status NOT IN (408, 409, 425, 429) THEN 'provider_rejected' ELSE 'provider_incomplete' END AS finish_status,
        attempts, attempts - 1 AS retry_count, latency_ms, CAST(http_status AS INTEGER) AS http_status, error_type, CASE WHEN error_type IS NOT NULL THEN sha256(message) END AS response_digest, CAST(faults AS BIGINT) AS faults,
        array_to_string(list_sort(list_transform(range(1, faults + 1), lambda i: 'bid_claims.' || i || ' bad [removed]'))[1:25], '|') AS shown FROM z""",
    "usage_ledger": f"WITH {A.COST} SELECT 'run' AS run_id, deal_slug, deal_slug || '_window_' || event_id AS window_id, 'p' AS provider, 'm' || (event_id % 2) AS model, CASE WHEN event_id % 3 = 0 THEN 'high' ELSE 'medium' END AS reasoning_effort, input_tokens, output_tokens, token_source FROM cost",
    "latency_ledger": f"WITH {A.COST} SELECT 'run' AS run_id, deal_slug, deal_slug || '_window_' || event_id AS window_id, latency_ms, retry_count, provider_failure FROM cost",
    "disposition_mix": Q.GRAPH + """, m AS (SELECT disposition, count(*) AS n FROM dis GROUP BY 1) SELECT '{' || string_agg('"' || disposition || '":' || n, ',' ORDER BY disposition) || '}' AS mix FROM m""",
    "ambiguity_queue": f"WITH f1 AS {_FAILED} SELECT check_name AS \"check\", table_name, row_id, detail FROM f",
    "validation_report": f"WITH f1 AS {_FAILED}, n AS (SELECT check_name, count(*) AS n FROM f GROUP BY 1) SELECT sum(n) = 0 AS passed, CAST(sum(n) AS BIGINT) AS hard_failures, '{{' || string_agg('\"' || check_name || '\":' || n, ',' ORDER BY check_name) || '}}' AS by_check FROM n",
    "cost_summary_rows": Q.COSTED + f""", mm AS (SELECT *, CASE WHEN deal_slug <> 'u3' THEN 1.5 END AS usd FROM met), t AS (
      SELECT g, count(*) AS deals, sum(windows) AS w, sum(input_tokens) AS i, sum(output_tokens) AS o, sum(claims) AS cl, {len(V.OBLIGATIONS)} * count(*) AS ob, sum(retry_count) AS r, sum(provider_failure_count) AS f, sum(quote_rejections) AS q,
        CASE WHEN count(DISTINCT token_usage_basis) = 1 AND max(token_usage_basis) IN ('actual', 'estimated') THEN max(token_usage_basis) ELSE 'mixed' END AS basis FROM mm, (VALUES ('three'), ('all')) v(g) WHERE g = 'all' OR deal_slug IN ('u1', 'u2', 'u3') GROUP BY g),
      n AS (SELECT *, unnest(CASE WHEN deals = 3 THEN [3, 9, 30, 400, 800] ELSE [deals] END) AS dc FROM t), p AS (SELECT *, dc / deals AS s, deals = 3 AS ok FROM n)
      SELECT CAST(dc AS BIGINT) AS deal_count, basis AS cost_basis, CAST(w AS DOUBLE) * s AS projected_windows, CAST(i AS DOUBLE) * s AS projected_input_tokens, CAST(o AS DOUBLE) * s AS projected_output_tokens, CASE WHEN ok THEN CAST(cl AS DOUBLE) * s END AS projected_claims,
        CASE WHEN ok THEN CAST(ob AS DOUBLE) * s END AS projected_coverage_obligations, CAST(r AS DOUBLE) * s AS projected_retry_count, CAST(f AS DOUBLE) * s AS projected_provider_failures, CASE WHEN ok THEN CAST(q AS DOUBLE) * s END AS projected_quote_validation_rejections,
        CASE WHEN ok THEN (CAST(i AS DOUBLE) * s * 3.0::DOUBLE + CAST(o AS DOUBLE) * s * 15.0::DOUBLE) / 1000000 END AS estimated_cost_usd, CAST(NULL AS DOUBLE) AS actual_cost_usd, CASE WHEN ok THEN 'linear_from_observed_three_deal_metrics' ELSE 'not_projected_requires_three_observed_deals' END AS assumption_basis, g AS deals_of FROM p""",
    "candidate_metrics": """WITH r AS (SELECT event_type AS stage, 'c' || (event_id % 4) AS candidate, event_id % 9 <> 0 AS ok, round(value, 2) AS dur, CASE WHEN event_id % 5 <> 0 THEN event_id % 997 END AS i, event_id % 101 AS o, CASE WHEN event_id % 3 <> 0 THEN (event_id % 100) / 100 END AS q, CASE WHEN event_id % 7 <> 0 THEN event_id % 50 ELSE 0 END AS n FROM events)
      SELECT stage, candidate, count(*) AS jobs_recorded, count(*) FILTER (ok) AS ok_jobs, count(*) FILTER (NOT ok) AS failed_jobs, round(count(*) FILTER (ok) / count(*), 4) AS ok_rate, round(avg(dur) FILTER (ok), 4) AS mean_duration_s, round(avg(i) FILTER (ok), 4) AS mean_input_tokens, round(avg(o) FILTER (ok), 4) AS mean_output_tokens,
        round(avg(q) FILTER (ok), 4) AS mean_quote_match_rate, CAST(coalesce(sum(n) FILTER (ok), 0) AS BIGINT) AS total_strict_claims, round(avg(n) FILTER (ok), 4) AS mean_strict_claims_per_ok_job FROM r GROUP BY 1, 2""",
    "request_schemas": f"WITH {A.CLM}, {A.OBL}, k AS (SELECT *, CAST(deal_slug[2:] AS BIGINT) % 4 AS m FROM obl), h AS (SELECT * FROM k WHERE m = 0 OR m = 1 AND expected_claim_type IN ('bid', 'event') OR m = 2 AND n % 2 = 0 OR m = 3 AND obligation_label <> 'Final bid price') SELECT deal_slug, sha256({_schema_sql()}) AS schema_sha256 FROM h GROUP BY deal_slug",
}

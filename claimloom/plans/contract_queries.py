"""Payloads with seeded defects, against what each must be found to lack."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from claimloom.operators import claims as C
from claimloom.operators import contract as K
from claimloom.plans import adaptors as A

COMMON = {"coverage_obligation_id": "o1", "confidence": "high", "quote_text": "q"}
GOOD = {
    "actor_claims": {**COMMON, "claim_type": "actor", "actor_label": "Party A", "actor_kind": "group", "observability": "named"},
    "event_claims": {**COMMON, "claim_type": "event", "event_type": "bid", "event_subtype": "ioi_submitted", "event_date": None, "description": "d", "actor_label": None, "actor_role": None},
    "bid_claims": {**COMMON, "claim_type": "bid", "bidder_label": "Party A", "bid_date": "2014-02-28", "bid_value": 17, "bid_value_lower": None, "bid_value_upper": "17.5", "bid_value_unit": None, "consideration_type": "cash", "bid_stage": "final"},
    "participation_count_claims": {**COMMON, "claim_type": "participation_count", "process_stage": "contacted", "actor_class": "mixed", "count_min": 3, "count_qualifier": "exact"},
    "actor_relation_claims": {**COMMON, "claim_type": "actor_relation", "subject_label": "a", "object_label": "b", "relation_type": "advises", "role_detail": None, "effective_date_first": None},
}


def _with(array: str, **changes) -> dict:
    """A payload of two items of an array, the second changed; a value of ... takes the field out."""
    item = {k: v for k, v in {**GOOD[array], **changes}.items() if v is not ...}
    return {array: [GOOD[array], item]}


CASES: list[tuple[str, list[tuple[str | None, int | None, str]]]] = [
    (json.dumps({name: [item] for name, item in GOOD.items()}), []),
    ("{}", []),
    ('{"actor_claims": [', [(None, None, "malformed")]),
    ("[1]", [(None, None, "malformed")]),
    (json.dumps({"other": 1, "bid_claims": []}), [(None, None, "unknown other")]),
    (json.dumps({"bid_claims": {"a": 1}}), [("bid_claims", None, "not an array")]),
    (json.dumps({"bid_claims": None}), [("bid_claims", None, "not an array")]),
    (json.dumps({"event_claims": ["x"]}), [("event_claims", 0, "not an object")]),
    (json.dumps(_with("actor_claims", extra=1, confidence="certainly", actor_kind="martian")), [("actor_claims", 1, "unknown extra"), ("actor_claims", 1, "bad confidence"), ("actor_claims", 1, "bad actor_kind")]),
    (json.dumps(_with("participation_count_claims", count_min="abc")), [("participation_count_claims", 1, "bad count_min")]),
    (json.dumps(_with("participation_count_claims", count_min=-1, count_max=2.5)), [("participation_count_claims", 1, "bad count_min"), ("participation_count_claims", 1, "bad count_max")]),
    (json.dumps(_with("participation_count_claims", count_min=None, count_max=None)), [("participation_count_claims", 1, "bad count_min")]),
    (json.dumps({"bid_claims": [GOOD["actor_claims"]]}), [("bid_claims", 0, f"{what} {n}") for what, names in (("unknown", ["actor_label", "actor_kind", "observability"]), ("missing", [n for n in GOOD["bid_claims"] if n not in GOOD["actor_claims"]]), ("bad", ["claim_type"])) for n in names]),
    (json.dumps(_with("event_claims", event_date="2014-02-30", description=..., coverage_obligation_id="")), [("event_claims", 1, "missing description"), ("event_claims", 1, "bad event_date"), ("event_claims", 1, "bad coverage_obligation_id")]),
    (json.dumps(_with("actor_relation_claims", subject_label=7, relation_type=None, role_detail=["x"])), [("actor_relation_claims", 1, f"bad {n}") for n in ("subject_label", "relation_type", "role_detail")]),
    (json.dumps({"bid_claims": []}) + " garbage", [(None, None, "malformed")]),
    (json.dumps({"bid_claims": []}) * 2, [(None, None, "malformed")]),
    (json.dumps({"bid_claims": []}) + "}", [(None, None, "malformed")]),
    (json.dumps(_with("bid_claims", bid_value="17d", bid_value_lower=" 1e3 ", bid_value_upper=True)), [("bid_claims", 1, "bad bid_value"), ("bid_claims", 1, "bad bid_value_upper")]),
    (json.dumps(_with("participation_count_claims", count_min="3", count_max=3_000_000_000)), []),
    (json.dumps(_with("participation_count_claims", count_min=3.0, count_max=10**20)), [("participation_count_claims", 1, "bad count_max")]),
    (json.dumps(_with("bid_claims", bid_value="17 dollars", bid_value_lower={}, bid_stage="last")), [("bid_claims", 1, f"bad {n}") for n in ("bid_value", "bid_value_lower", "bid_stage")]),
]


def _dealt(s, d, *columns):
    """The events dealt by their ids: payloads cost much more to read than to deal, and a file may have as few parts as one. What is grouped or joined by event_id behind this is in place."""
    return A.table(s, d, "events").select("event_id", *columns).repartition(int(s.conf.get("spark.sql.shuffle.partitions")), "event_id")


def payload_contract(s, d):
    """The faults of one payload for each event, dealt out from the cases."""
    cases = s.createDataFrame([(k, text) for k, (text, _) in enumerate(CASES)], "k long, payload string")
    rows = _dealt(s, d).select("event_id", (F.col("event_id") % len(CASES)).alias("k"))
    return K.payload_faults(rows.join(F.broadcast(cases), "k"), "event_id")


def payload_values(s, d):
    """Each event as a payload of one bid or count, its numbers spelled in six ways, one of them no number: its fault, or the values that arrive."""
    e = _dealt(s, d, "value").select("event_id", F.round("value", 2).alias("v"), (F.col("event_id") % 6).alias("k"), (F.col("event_id") % 4 == 0).alias("counts"))
    v, n = F.col("v").cast("string"), (F.col("event_id") * 5_000_000).cast("string")
    quoted = lambda x: F.concat(F.lit('"'), x, F.lit('"'))
    spelled = lambda x, whole: F.when(F.col("k") == 0, x).when(F.col("k") == 1, quoted(x)).when(F.col("k") == 2, F.concat(x, F.lit("e0"))).when(F.col("k") == 3, quoted(F.concat(F.lit(" +"), x, F.lit("e+0 ")))).when(F.col("k") == 4, F.concat(x, F.lit("" if not whole else ".0"))).otherwise(quoted(F.concat(x, F.lit("d"))))
    item = lambda array, **own: F.concat(F.lit('{"' + array + '": [{' + "".join(f'"{k}": {json.dumps(w)}, ' for k, w in GOOD[array].items() if k not in own)), F.concat_ws(", ", *(F.concat(F.lit(f'"{k}": '), w) for k, w in own.items())), F.lit("}]}"))
    text = F.when(F.col("counts"), item("participation_count_claims", count_min=spelled(n, True))).otherwise(item("bid_claims", bid_value=spelled(v, False)))
    made = e.select(F.col("event_id").alias("request_id"), text.alias("payload"))
    faults = K.payload_faults(made).groupBy("request_id").agg(F.max("fault").alias("fault"))
    values = C.flatten(C.parse_payloads(made)).select("request_id", "bid_value", "count_min")
    return values.join(faults, "request_id", "left").select(F.col("request_id").alias("event_id"), "fault", "bid_value", "count_min")


def _sql(x) -> str:
    return "NULL" if x is None else str(x) if isinstance(x, int) else "'" + x + "'"


QUERIES = {"payload_contract": payload_contract, "payload_values": payload_values}
ORACLE_SQL = {
    "payload_contract": "WITH f(k, claim_array, pos, fault) AS (VALUES "
    + ", ".join(f"({k}, {_sql(a)}, CAST({_sql(p)} AS INTEGER), {_sql(w)})" for k, (_, faults) in enumerate(CASES) for a, p, w in faults)
    + f") SELECT event_id, claim_array, pos, fault FROM events JOIN f ON event_id % {len(CASES)} = k",
    "payload_values": "SELECT event_id, CASE WHEN event_id % 6 <> 5 THEN NULL WHEN event_id % 4 = 0 THEN 'bad count_min' ELSE 'bad bid_value' END AS fault, CASE WHEN event_id % 6 <> 5 AND event_id % 4 <> 0 THEN round(value, 2) END AS bid_value, CASE WHEN event_id % 6 <> 5 AND event_id % 4 = 0 THEN event_id * 5000000 END AS count_min FROM events",
}

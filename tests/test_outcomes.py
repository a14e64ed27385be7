"""The end of a request's attempts, merged maps, a request's own schema, cost rows and observed failures."""

import json

from pyspark.sql import functions as F

from claimloom.operators import contract as K
from claimloom.operators import outcomes as O
from claimloom.operators import project as P

ATTEMPTS = "request_id string, attempt int, status int, error_type string, error_code string, message string, latency_ms long"


def test_each_state(spark):
    rows = [
        ("ok", 1, None, None, None, None, 5), ("late", 1, 503, "InternalServerError", None, "x", 5), ("late", 2, 200, None, None, None, None), ("late", 3, 400, "BadRequestError", None, "not counted", 99),
        ("refused", 1, 400, "BadRequestError", None, "no", 1), ("refused", 2, None, None, None, None, 9), ("spent", 1, 429, "RateLimitError", None, "a", 1), ("spent", 2, None, "TimeoutError", None, "b", 2), ("spent", 3, 408, "APIError", None, "c", 3),
        ("open", 1, None, "APIConnectionError", None, "x", 1), ("contract", 1, 503, "LinkflowProviderContractError", None, None, 1), ("stream", 1, 404, "APIError", "stream_read_error", "x", 1), ("stream", 2, None, None, None, None, 1), ("odd", 1, None, "ValueError", None, "x", 1), ("bad", 1, None, None, None, None, 1), ("teapot", 1, 425, "APIError", None, "x", 1), ("teapot", 2, 422, "APIError", None, "x", 1),
    ]
    faults = spark.createDataFrame([("bad", "bid_claims", i, "bad x sk-abc123 Authorization: Bearer t0k") for i in range(40)] + [("none", None, None, "malformed")], "request_id string, claim_array string, pos int, fault string")
    found = {r["request_id"]: r for r in O.provider_outcomes(spark.createDataFrame(rows, ATTEMPTS), faults).collect()}
    assert {k: (r["finish_status"], r["attempts"], r["latency_ms"]) for k, r in found.items()} == {
        "ok": ("completed", 1, 5), "late": ("completed", 2, 5), "refused": ("provider_rejected", 1, 1), "spent": ("provider_incomplete", 3, 6), "open": ("pending", 1, 1), "contract": ("contract_invalid", 1, 1),
        "stream": ("completed", 2, 2), "odd": ("provider_incomplete", 1, 1), "bad": ("contract_invalid", 1, 1), "teapot": ("provider_rejected", 2, 2),
    }
    assert found["bad"]["faults"] == 40 and len(found["bad"]["shown"]) == 25 and not any("sk-" in x or "t0k" in x for x in found["bad"]["shown"])
    assert len(found["contract"]["response_digest"]) == 64 and found["ok"]["response_digest"] is None
    assert O.provider_outcomes(spark.createDataFrame([], ATTEMPTS)).count() == 0


def test_merged_maps(spark):
    df = spark.createDataFrame([("a", {"x": 1, "y": 2}), ("a", {"y": 5, "b": 1}), ("b", {}), ("c", None), ("c", {"z": None})], "k string, m map<string,bigint>").repartition(3)
    assert {r["k"]: r["j"] for r in O.merged_counts(df, "m", "k").select("k", F.to_json("m").alias("j")).collect()} == {"a": '{"b":1,"x":1,"y":7}', "b": "{}", "c": '{"z":0}'}
    assert [r[0] for r in O.merged_counts(df, "m").select(F.to_json("m")).collect()] == ['{"b":1,"x":1,"y":7,"z":0}']


def words(node):
    if isinstance(node, dict):
        return {*node, *(w for v in node.values() for w in words(v))}
    return {w for v in node for w in words(v)} if isinstance(node, list) else set()


def test_a_request_states_its_own_obligations(spark):
    duty = "obligations array<struct<obligation_id: string, expected_claim_type: string, obligation_label: string>>"
    rows = [
        ([("o1", "bid", "Final bid price"), ('o"2', "actor", "Bidders"), ("o3", "actor", "Target")],), ([("o1", "bid", "Final bid price"), ("o2", "bid", "Other")],), ([("r", "actor_relation", "Buyer group composition")],), ([],), ([("n", "bid", None)],),
    ]
    made = [json.loads(r[0]) for r in spark.createDataFrame(rows, duty).select(K.schema_of(F.col("obligations"))).collect()]
    field = lambda i, array, name: made[i]["properties"][array]["items"]["properties"][name]["enum"]
    assert field(0, "bid_claims", "coverage_obligation_id") == ["o1"] and field(0, "actor_claims", "coverage_obligation_id") == ['o"2', "o3"] and field(0, "event_claims", "coverage_obligation_id") == ["__no_event_coverage_obligation__"]
    assert field(0, "bid_claims", "bid_stage") == ["final"] and len(field(1, "bid_claims", "bid_stage")) == 4 and len(field(4, "bid_claims", "bid_stage")) == 4
    assert field(2, "actor_relation_claims", "relation_type") == ["member_of", "affiliate_of", "controls", "acquisition_vehicle_of"] and len(field(3, "actor_relation_claims", "relation_type")) > 4
    for schema in made:
        assert not words({k: v for k, v in schema.items() if k != "required"}) & {"default", "examples", "format", "maximum", "maxLength", "minimum", "minItems", "minLength", "pattern", "title"}
        for array in schema["properties"].values():
            assert not array["items"]["additionalProperties"] and array["items"]["required"] == list(array["items"]["properties"]) or sorted(array["items"]["required"]) == sorted(array["items"]["properties"])


def test_only_three_deals_are_projected(spark):
    schema = "windows long, input_tokens long, output_tokens long, claims long, coverage_obligations long, retry_count long, provider_failure_count long, quote_rejections long, cost_usd double, token_usage_basis string"
    row = (2, 100, 10, 5, 10, 1, 0, 2, 0.5, "actual")
    for n, expected in ((3, [3, 9, 30, 400, 800]), (2, [2]), (4, [4]), (0, [0])):
        found = P.cost_rows(spark.createDataFrame([row] * n, schema), 1.0, 2.0).collect()
        assert [r["deal_count"] for r in found] == expected
        assert all((r["projected_claims"] is None) == (n != 3) and (r["estimated_cost_usd"] is None) == (n != 3) for r in found)
    three = P.cost_rows(spark.createDataFrame([row] * 3, schema), 1.0, 2.0).collect()
    assert three[0]["actual_cost_usd"] == 1.5 and three[1]["actual_cost_usd"] is None and three[1]["projected_windows"] == 18.0


def test_numbers_of_failures_come_with_the_write(spark, tmp_path):
    df = spark.createDataFrame([("a", "t", str(i), "d") for i in range(7)] + [("b", "t", "x", "d")], "check_name string, table_name string, row_id string, detail string").repartition(3)
    watched, seen = O.observed(df, ["a", "b", "c"])
    watched.write.parquet(f"{tmp_path}/f")
    assert seen.get == {"hard_failures": 8, "a": 7, "b": 1, "c": 0}
    assert tuple(O.validation_report(df).first()) == (False, 8, {"a": 7, "b": 1}) and tuple(O.validation_report(df.limit(0)).first()) == (True, 0, {})

"""Accepted numbers arrive and refused ones are faults: the contract and the values against the same rule in Python."""

import json
import random
import re

from claimloom.operators import claims as C
from claimloom.operators import contract as K
from claimloom.plans.contract_queries import GOOD

NUMBER = re.compile(r"\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*", re.ASCII)


def number(v):
    """(accepted, value) of a JSON value in a number's field."""
    if v is None:
        return True, None
    if isinstance(v, bool) or not isinstance(v, (int, float, str)) or isinstance(v, str) and not NUMBER.fullmatch(v):
        return False, None
    x = float(v)
    return (True, x) if abs(x) < float("inf") else (False, None)


def count(v):
    ok, x = number(v)
    if not ok or x is None or x < 0 or x != int(x):
        return False, None
    plain = int(v) if isinstance(v, int) or isinstance(v, str) and v.strip().lstrip("+").isdigit() else None
    if plain is not None and plain < 2**63:
        return True, plain
    return (True, int(x)) if x < 2**53 else (False, None)


def test_every_value_is_a_fault_or_arrives(spark):
    rng = random.Random(6)
    fixed = [None, True, False, 17, "17", "17.5", " 17 ", "+3", "-3", -3, 0, -0.0, 3.0, "3.0", 2.5, "2.5", 3_000_000_000, "3000000000", 2**63 - 1, 2**63, 10**25, "1e3", "1E+2", "1e-3", ".5", "5.", ".", "", " ", "17d", "17f", "0x1F", "1_000", "NaN", "Infinity", "inf", "1e999", "１７", "17 dollars", [], [1], {}, {"a": 1}, "null", "1e3d"]
    values = fixed + [rng.choice([rng.randrange(-5, 10**rng.randrange(1, 20)), round(rng.uniform(-5, 1e6), rng.randrange(6)), str(rng.randrange(10**6)), f"{rng.uniform(0, 99):.3f}"]) for _ in range(150)]
    rows = []
    for i, v in enumerate(values):
        rows.append((f"n{i}", json.dumps({"bid_claims": [{**GOOD["bid_claims"], "bid_value": v}]})))
        rows.append((f"c{i}", json.dumps({"participation_count_claims": [{**GOOD["participation_count_claims"], "count_min": v}]})))
    df = spark.createDataFrame(rows, "request_id string, payload string")
    faulty = {r["request_id"] for r in K.payload_faults(df).collect()}
    flat = {r["request_id"]: r for r in C.flatten(C.parse_payloads(df)).collect()}
    for i, v in enumerate(values):
        for ident, rule, field in ((f"n{i}", number, "bid_value"), (f"c{i}", count, "count_min")):
            ok, value = rule(v)
            assert (ident not in faulty) == ok, (field, v)
            assert flat[ident][field] == value, (field, v, flat[ident][field])


def test_one_object_and_nothing_else(spark):
    good = json.dumps({"bid_claims": []})
    texts = {good: True, f" {good}\n": True, "{}": True, good + " garbage": False, good * 2: False, good + "}": False, good + "]": False, f"{good},{good}": False, good + ', "y": {}': False, "x" + good: False, "": False, "[]": False, "1": False, '{"bid_claims": [}': False, '{"bid_claims": []}, "y": 1} rest': False, "null": False}
    df = spark.createDataFrame(list(enumerate(texts)), "request_id long, payload string")
    faulty = {r["request_id"] for r in K.payload_faults(df).where("fault = 'malformed'").collect()}
    bad = {r["request_id"] for r in C.parse_payloads(df).where("parse_error = 'malformed'").collect()}
    assert faulty == bad == {i for i, ok in enumerate(texts.values()) if not ok}


def test_payloads_are_read_in_one_pass(spark, capsys):
    df = spark.createDataFrame([(1, "{}")], "request_id long, payload string")
    K.payload_faults(df).explain()
    assert len(re.findall(r"(?m)^\W*Scan ", re.sub(r"\* ?|\(\d+\) ", "", capsys.readouterr().out))) == 1


def test_payloads_are_dealt_before_they_are_read(spark):
    """One file of one part must not be read by one task, and what is grouped and joined by event is not dealt again; the check of fields is small enough for the JVM to compile."""
    from claimloom.plans.contract_queries import payload_values

    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # its first plan is not compiled
    try:
        plan = payload_values(spark, "/root/testdata/sf0.001")._jdf.queryExecution()
        shown, compiled = (plan.explainString(mode.fromString(m)) for m in ("simple", "codegen"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    dealt = re.findall(r"(?<!Broadcast)Exchange (\w+)\((\w+?)#\d+L?, \d+\), (\w+)", shown)
    assert set(dealt) == {("hashpartitioning", "event_id", "REPARTITION_BY_NUM")}
    assert "Filter (isnotnull(told" in compiled
    assert all(int(size) < 8000 for size in re.findall(r"maxMethodCodeSize:(\d+)", compiled))

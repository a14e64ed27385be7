"""Proof, counts and numbering over small hand-made tables."""

import random

from pyspark.sql import functions as F

from claimloom.functions.ids import in_ranges, placed
from claimloom.operators import project as P
from claimloom.operators.reconcile import CANONICAL
from claimloom.sources.shared import stored


def tables(spark):
    make = spark.createDataFrame
    canonical = {name: make([(f"{name}{i}",) for i in range(n)], f"{key} string") for (name, key), n in zip(CANONICAL.items(), (1, 1, 3, 2, 4, 2, 0))}
    return {
        "claims": make([("c1",), ("c2",), ("c3",), ("c3",)], "claim_id string"),
        "obligations": make([("o1", True, "required"), ("o2", True, "important"), ("o3", True, "optional"), ("o4", False, "required"), ("o5", True, "required"), ("o6", None, None)], "obligation_id string, current boolean, importance string"),
        "results": make([("o1", "claims_emitted", True), ("o2", "claims_emitted", False), ("o5", "claims_emitted", True), ("o5", "missed", True), ("o3", "missed", True), ("zz", "missed", True)], "obligation_id string, result string, current boolean"),
        "dispositions": make([("c1", True), ("c2", False), ("c9", True)], "claim_id string, current boolean"),
        "canonical": canonical,
        "row_evidence": make([("actors", "actors0"), ("actors", "actors1"), ("events", "actors2"), ("events", "events3"), ("events", "events3"), ("deals", "deals0")], "row_table string, row_id string"),
        "bidders": make([(1,), (2,)], "x int"),
        "failures": make([], "detail string"),
    }


def test_proof_counts_each_lack_once(spark):
    row = P.proof(P.facts(**tables(spark))).first().asDict()
    # o2 has no current result, o5 one that is met and one that isn't; claims c2 and both rows of c3 have no current disposition.
    assert row == {"live_claims": 4, "obligations": 6, "insufficient": 2, "undisposed": 3, "unevidenced": 13 - 4, "bidder_rows": 2, "actors": 3, "events": 4, "failures": 0, "verdict": "SUSPECT"}


def test_proof_of_nothing_is_blocked(spark):
    empty = {k: {n: df.limit(0) for n, df in v.items()} if isinstance(v, dict) else v.limit(0) for k, v in tables(spark).items()}
    row = P.proof(P.facts(**empty)).first().asDict()
    assert row.pop("verdict") == "BLOCKED" and set(row.values()) == {0}


def test_counts_of_empty_tables(spark):
    t = {"a": spark.range(3), "b": spark.range(0).withColumn("z", F.lit(1))}
    assert sorted(map(tuple, P.row_counts(t).collect())) == [("a", 3), ("b", 0)]


def test_deal_summaries_keep_deals_without_rows_and_no_others(spark):
    deals = spark.createDataFrame([("x",), ("y",)], "deal_slug string")
    rows = spark.createDataFrame([("x",), ("x",), ("q",)], "deal_slug string")
    found = P.deal_summaries(deals, {"one": rows, "two": rows.limit(0)})
    assert found.columns == ["deal_slug", "one", "two"] and sorted(map(tuple, found.collect())) == [("x", 2, 0), ("y", 0, 0)]


def test_places_over_many_ranges_with_a_heavy_key(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", f"k{rng.randrange(40)}"]), i) for i in range(3000)] + [(None, 5000)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(7)
    order = ["k", "v"]
    ranged = stored(df.repartitionByRange(9, *order).withColumn("part", F.spark_partition_id()), "t")
    assert ranged.select("part").distinct().count() > 5
    found = placed(ranged, order)
    key = lambda r: (r[0] is not None, r[0] or "", r[1])
    assert [(r["k"], r["v"]) for r in sorted(found.collect(), key=lambda r: r["place"])] == sorted(rows, key=key)
    assert sorted(r["place"] for r in found.collect()) == list(range(1, 3002))
    assert placed(stored(in_ranges(df.limit(0), order), "t"), order).count() == 0


def test_no_single_task_numbers_all(spark):
    slugs = spark.createDataFrame([(f"s{i:03}",) for i in range(50)] * 2, "deal_slug string")
    plan = P.shard_plan(slugs, 7)
    assert "SinglePartition" not in plan._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["source_order"], r["deal_slug"], r["shard_id"]) for r in plan.collect()) == [(i + 1, f"s{i:03}", f"shard-{i // 7 + 1:04}") for i in range(50)]


def test_proof_sorts_no_facts(spark):
    plan = P.proof(P.facts(**tables(spark)))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[family" in plan and "SortAggregate" not in plan

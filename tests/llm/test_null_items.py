"""Benchmark items without an id."""

from claimloom.llm import decontamination as D


def test_items_without_an_id_are_found(spark):
    item, other = "what is the name of the seventh river of the old land", "which of these nine small towns lies on the northern coast"
    docs = spark.createDataFrame([(1, f"before it {item} after it"), (2, f"{other} and {item}"), (3, "nothing of the kind is here at all"), (4, other)], "doc_id long, text string")
    bench = spark.createDataFrame([(None, item), (7, other), (None, None), (None, "")], "item_id long, text string")
    got = {r["doc_id"]: [m["item_id"] for m in r["leaks"]] for r in D.find_leaks(docs, bench).collect()}
    assert got == {1: [None], 2: [7, None], 3: [], 4: [7]}
    assert [r["doc_id"] for r in D.drop_leaks(docs, bench).collect()] == [3]

"""Short lines in line dedup, in the query and in the pipeline's stage."""

import hashlib

import pytest

import corpus_pipeline
from claimloom.llm import line_dedup as L


@pytest.fixture
def table(spark, tmp_path):
    long = "a line of some words that stands alone in document "
    rows = [(1, f"short\n\n{long}one and only\nshort"), (2, f"short\nshart\n \n\n{long}two, unlike all else here"), (3, "fresh words\nand more\nof them\n" + f"{long}one and only")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_short_repeats_go(spark, table):
    long = "a line of some words that stands alone in document "
    want = {1: f"short\n\n{long}one and only", 2: f"shart\n \n\n{long}two, unlike all else here", 3: "fresh words\nand more\nof them"}
    got = {r["doc_id"]: r for r in L.op2_line_dedup(spark, table).collect()}
    assert {d: r["text_sha256"] for d, r in got.items()} == {d: hashlib.sha256(t.encode()).hexdigest() for d, t in want.items()}
    assert [got[d]["n_dropped"] for d in (1, 2, 3)] == [1, 1, 1]
    staged = {r["doc_id"]: r["text"] for r in corpus_pipeline.lines(spark, spark.read.parquet(f"{table}/documents.parquet"), table).collect()}
    assert staged[1] == want[1] and staged[2] == want[2]


def test_fresh_short_lines_weigh(spark, table):
    docs = spark.read.parquet(f"{table}/documents.parquet")
    assert sorted(r["doc_id"] for r in corpus_pipeline.lines(spark, docs, table).collect()) == [1, 2, 3]
    assert sorted(r["doc_id"] for r in L.keep_fresh(docs, short=False).collect()) == [1, 2, 3]
    copy = docs.where("doc_id = 1").selectExpr("4L as doc_id", "concat('x y', chr(10), text) as text")
    assert sorted(r["doc_id"] for r in L.keep_fresh(docs.unionByName(copy)).collect()) == [1, 2, 3]

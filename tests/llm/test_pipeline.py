"""The stages on a small table, and the registration."""

import pytest

import __spark_entry__
import corpus_pipeline
from claimloom.llm import queries
from tests.oracle import connect, same

SF = "/root/testdata/sf0.001"


def test_registered():
    names = __spark_entry__.queries()
    assert set(queries.QUERIES) <= set(names) and "pipeline" in names and "pipeline" not in __spark_entry__.oracle_sql()
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if name != "packing":
            assert docs.columns == columns
            counts.append(docs.count())
    assert counts[0] > counts[2] >= counts[3] >= counts[4] > 0.7 * counts[0]
    sizes = [r["total"] for r in docs.groupBy("sequence_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "total").collect()]
    assert max(sizes) <= 2048


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracle(spark, name):
    same(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLE_SQL[name])

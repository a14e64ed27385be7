"""Columns of the user that are named like an operator's own, repeated rows in shards, and broken media."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from claimloom.llm import progressive_jpeg as J
from claimloom.llm import sharding
from claimloom.llm.common import kept, sifted

SF = "/root/testdata/sf0.001"
NAMES = {"score": 77.0, "leaks": "mine", "n_lines": "x", "Lang_Pred": 1, "shard": 3, "size": "s", "hash__": 5, "id__": 6, "rows": "r", "drop_id__": 1, "curve": 2}


def test_stages_keep_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({k: F.lit(v) for k, v in NAMES.items()})
    own = list(NAMES)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if name == "packing":
            assert docs.count() > 0
            break
        docs = kept(docs, name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *own]
        assert [tuple(r) for r in docs.select(*own).distinct().collect()] == [tuple(NAMES.values())], name


def test_stages_of_hard_rows(spark, docs, empty):
    for table in (docs.unionByName(docs), empty):
        left = table
        for name, stage in corpus_pipeline.STAGES:
            left = kept(stage(spark, left, SF), name)
            if name != "packing":
                assert left.columns == table.columns
        assert (left.count() == 0) == (table.count() == 0)


@pytest.mark.parametrize("row", [(5, "the same text"), (None, None), (None, "x"), (5, None)])
def test_repeated_rows_are_shared_out(spark, tmp_path, row):
    docs = spark.createDataFrame([(*row, "en", "s", 1)] * 800, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = sharding.op10_sharding(spark, str(tmp_path)).collect()
    per = {}
    for r in found:
        per.setdefault(r["shard"], []).append(r["slot"])
    assert {k: sorted(v) for k, v in per.items()} == {k: list(range(100)) for k in range(8)}


def test_repeated_rows_between_others(spark, tmp_path):
    rows = [(7, "hot text", "en", "s0", i) for i in range(300)] + [(i, f"text {i} " * (i % 9), "en", f"s{i % 5}", 1000 + i) for i in range(500)] + [(8, "cold", "de", "s1", i) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    out = f"{tmp_path}/shards"
    sharding.write_shards(docs, {"lang": F.col("lang"), "size": F.octet_length("text")}, out)
    found = sharding.read_shards(spark, out).select("r.*", "size", "shard", "slot").collect()
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in found) == sorted((r[0], r[1], r[4]) for r in rows)
    sizes, longest = {}, max(len(r[1]) + 1 for r in rows)
    for r in found:
        sizes.setdefault(r["shard"], []).append(r)
    totals = [sum(r["size"] for r in v) for v in sizes.values()]
    assert len(totals) == 8 and max(totals) - min(totals) <= 2 * longest
    assert all(sorted(r["slot"] for r in v) == list(range(len(v))) for v in sizes.values())


def test_broken_media_have_nulls_and_never_another_error(spark):
    media = J.encode_media(spark.createDataFrame([(1, "some text of a file " * 20)], "doc_id long, text string")).collect()[0]
    raw = bytes(media[2])
    broken = [raw[:k] + bytes([raw[k] ^ bit]) + raw[k + 1 :] for k in range(0, min(len(raw), 700)) for bit in (1, 64)]
    faults = 0
    for x in broken:
        try:
            J.rgb(J.decode(x))
        except ValueError:
            faults += 1
    assert faults
    df = spark.createDataFrame([(1, 5, bytearray(raw)), (2, 5, None), (3, 5, bytearray(b"")), (4, 5, bytearray(b"no file"))], "doc_id long, n_bytes long, media binary")
    rows = {r["doc_id"]: r for r in J.digest_media(df).collect()}
    assert rows[1]["feature"] and rows[1]["payload_bytes"] and rows[2]["media_bytes"] is None and rows[4]["media_bytes"] == 7
    assert all(rows[k]["feature"] is None and rows[k]["payload_sha256"] is None for k in (2, 3, 4))


def test_sieve_holds_back_most_and_loses_none(spark):
    df = spark.range(-3000, 3000).withColumnRenamed("id", "k").withColumn("v", F.lit("x"))
    keys = spark.range(0, 3000, 100).withColumnRenamed("id", "k")
    left = [r["k"] for r in sifted(df, "k", keys).collect()]
    assert set(range(0, 3000, 100)) <= set(left) and len(left) < 40
    assert len([r for r in sifted(df, "k", keys, bits=1 << 15).collect()]) < 60
    assert sifted(df, "k", keys.limit(0)).count() == 0

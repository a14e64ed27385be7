"""Token ids in ORC: stripes of run-length-encoded integers, row indexes, and Bloom filters on document ids.

Rows are dealt by document id into ranges, sorted, encoded, and written one file a range. Stripes are the unit
of parallel reads; footers, row indexes and Bloom filters let a reader skip all but the stripes of its documents.
Each row also holds its range's number and the ids before it in the range, so that a document's place in the
whole sequence needs only one sum a range, read from the files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimloom.llm.common import map_arrow, new_path, table
from claimloom.llm.pieces import byte_balanced, encoder, vocabulary

END_ID = 2
ORC = {"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.create.index": "true", "orc.row.index.stride": "2000", "orc.stripe.size": str(16 << 20), "compression": "zstd"}


def write_token_ids(df: DataFrame, out: str, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, batch_bytes: int = 4 << 20) -> None:
    """Writes an ORC table (doc_id, range, before, n_tokens, ids) at `out`, in ascending document id over its files.

    Null texts are empty and still get end_id. Null ids come first; rows of one id are ordered by text, so
    repeated rows are interchangeable and all are written. Other columns are left out, whatever their names; ids and
    texts are cast to long and string. An empty table gives an
    empty one. No row is longer than its text's ids; a range is sorted by Spark and may spill.
    """
    path = path or vocabulary("byte_bpe_50k.json")
    end = int(end_id)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, before = encoder(path), 0
        for batch in batches:
            texts, docs, numbers = batch.column("text"), batch.column("doc_id"), batch.column("range")
            for part in byte_balanced(texts, batch_bytes):
                ids, at = enc.encode(texts[part])
                n = np.diff(at) + 1
                offsets = np.concatenate([[0], np.cumsum(n)])
                values = np.insert(ids.astype("i4"), at[1:], end)
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype("i4")), pa.array(values))
                yield pa.RecordBatch.from_arrays([docs[part], numbers[part], pa.array(before + offsets[:-1]), pa.array(n), lists], names=["doc_id", "range", "before", "n_tokens", "ids"])
                before += int(offsets[-1])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    dealt = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    coded = dealt.withColumn("range", F.spark_partition_id()).transform(map_arrow, encode, "doc_id long, range int, before long, n_tokens long, ids array<int>")
    coded.write.options(**ORC).orc(out)


def read_token_ids(spark: SparkSession, out: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The table at `out` with `start`, the ids of all documents before each; doc_ids prunes stripes by index and Bloom filter."""
    rows = spark.read.schema("doc_id long, range int, before long, n_tokens long, ids array<int>").orc(out)
    sums = rows.groupBy("range").agg(F.sum("n_tokens").alias("total"))
    # One row for each range, which is bounded by the number of partitions written.
    first = sums.select("range", F.coalesce(F.sum("total").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    if doc_ids is not None:
        rows = rows.where(F.col("doc_id").isin(doc_ids))
    return rows.join(F.broadcast(first), "range").select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids")


def ids_digest(df: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the unsigned crc32 of each row's ids as little-endian unsigned 32-bit integers."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            raw = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<u4")).cast("B")
            offsets = lists.offsets.to_numpy().astype("i8") * 4
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.array(np.diff(offsets) // 4), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return df.transform(map_arrow, digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes documents into ORC files in the shared folder, reads them back, and digests what they hold."""
    out = new_path(spark, "token-ids")
    write_token_ids(table(spark, sf_dir, "documents"), out)
    return ids_digest(read_token_ids(spark, out))

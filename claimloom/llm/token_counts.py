"""Token counts: batch encoding in Arrow functions that return lengths only.

No row is shuffled; text enters a worker in Arrow batches, is cut into slices of about `batch_bytes`, and only
numbers leave it. Slices are balanced by UTF-8 bytes, not by rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm.common import add_columns, table
from claimloom.llm.pieces import byte_balanced, encoder, vocabulary


def token_counts(df: DataFrame, path: str | None = None, text_col: str = "text", limit: int = 1024, batch_bytes: int = 4 << 20) -> DataFrame:
    """df with n_bytes (UTF-8 length), n_tokens and over_limit (n_tokens > limit).

    Texts are encoded whole, without special tokens, truncation or padding; those above batch_bytes are cut at safe
    boundaries (see pieces) and their counts added. Null and empty texts count 0 bytes and 0 tokens. Repeated rows
    are counted each; an empty table gives an empty one. Other columns pass through; columns named like an output
    are replaced.
    """
    path = path or vocabulary("byte_bpe_50k.json")

    def start():
        enc = encoder(path)
        return lambda texts: [np.concatenate([enc.count(texts[part]) for part in byte_balanced(texts, batch_bytes)] or [np.zeros(0, "i8")])]

    counted = df.withColumn("n_bytes", F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long"))
    counted = add_columns(counted, [text_col], "n_tokens long", start, arrow_in=True)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text of documents by the byte-level vocabulary."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")

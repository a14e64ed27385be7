"""The corpus pipeline: five stages over documents, each written as Parquet and read by the next.

Documents without a known language go; repeated lines go, and documents that are copies by their lines; of near
copies by shingles one stays; documents that hold benchmark items go; the rest is packed. All but the last stage
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimloom.llm import decontamination, language_id, line_dedup, near_copies as copies, packing
from claimloom.llm.common import kept, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose text has no letters, or no language with a score of 0.3; learns from docs' own labels outside the held-out quarter."""
    return language_id.keep_known(docs, language_id.learned(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines within two edits of an earlier one, and documents of which such lines hold 80 % or more of the characters."""
    return line_dedup.keep_fresh(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of documents linked by a similarity of 0.8 or more of their five-word shingles."""
    return copies.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a window of five-word shingles of similarity 0.8 or more to a benchmark item."""
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of windows of at most 2048 tokens, with their ids."""
    return packing.pack(docs)


STAGES = [("language_id", language), ("line_dedup", lines), ("simhash", near_copies), ("decontamination", benchmark), ("packing", packed)]

#: Networks, tokenizers and fingerprints have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows: pieces of packed windows (see packing.pack)."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = kept(docs, f"pipeline-{name}")
    return docs

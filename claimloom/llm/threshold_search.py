"""Ranked lexical search by Fagin's threshold algorithm.

A first pass writes a forward index: for each document its number of terms and the queries' terms in it with their
counts. The corpus counts come from that table. A second pass gives each task shards of the forward index. A shard is
inverted into one list for each term, sorted by impact, and each query reads its lists in turn, a few entries further
each round. A document that is met for the first time gets its exact score from the forward index. The threshold is
what a document would score that no list has shown yet; once it falls strictly below the score of the k-th best,
nothing unseen can rank, ties included. The best of a task carry over to its next shard, so later shards stop sooner.
Tasks give k rows a query at most, which are ranked in two steps.

Queries are taken in blocks of bounded size, each with a forward index of its own, so neither the driver nor a task
holds more than one block of them.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimloom.llm.common import add_columns, dropped, kept, map_arrow, table
from claimloom.llm.words import word_lists

K, SHARD_POSTINGS, BLOCK_BYTES = 50, 1 << 21, 1 << 20
#: Constants of the score, which is all in integers.
SCALE, COUNT_UNIT, LENGTH_UNIT, FLAT, SLOPE = 1_000_000_000, 1000, 20, 50, 50


def query_terms(text: str | None) -> list[bytes]:
    return sorted({w for words in word_lists(text) for w in words})


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_factor(n_terms: int, n_docs: int, total: int) -> int:
    return FLAT + (SLOPE * n_terms * n_docs) // total


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (SCALE * tf) // (COUNT_UNIT * tf + LENGTH_UNIT * m)


def query_blocks(queries: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """(id, terms) of the queries in blocks of bounded size, one at a time on the driver. Rows of one id are one query."""
    grouped = queries.where(F.col(text_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.array_join(F.collect_set(F.col(text_col).cast("string")), "\n").alias("text"))
    held, size = [], 0
    for r in grouped.toLocalIterator():
        if terms := query_terms(r["text"]):
            held.append((r["id"], terms))
            size += sum(map(len, terms))
        if size >= block_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


def forward_index(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n_terms, and the vocabulary's terms in the text (by place) with their counts; documents without terms are left out."""

    def start():
        place = {w: i for i, w in enumerate(vocabulary)}

        def one(text):
            n, found = 0, Counter()
            for words in word_lists(text):
                n += len(words)
                found.update(filter(place.__contains__, words))
            hits = sorted((place[w], k) for w, k in found.items())
            return n, [i for i, _ in hits], [k for _, k in hits]

        def made(texts):
            return list(zip(*map(one, texts))) or [[], [], []]

        return made

    return add_columns(docs, ["text"], "n_terms long, terms array<int>, counts array<long>", start).drop("text").where("n_terms > 0")


def statistics(index: DataFrame, size: int) -> tuple[int, int, list[int]]:
    """Documents with terms, their terms with repeats, and for each of `size` places the documents that hold it."""
    n, total = index.agg(F.count("*"), F.coalesce(F.sum("n_terms"), F.lit(0))).first()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size, "i8")
        for batch in batches:
            seen += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype("i4")), pa.array(seen[at])], names=["term", "docs"])

    counts = [0] * size
    for r in map_arrow(index.select("terms"), run, "term int, docs long").groupBy("term").agg(F.sum("docs").alias("docs")).toLocalIterator():  # one row a place of the block
        counts[r["term"]] = r["docs"]
    return n, total, counts


class Shard:
    """Some documents' postings, forward by document and inverted by falling impact."""

    def __init__(self, doc_ids: np.ndarray, starts: np.ndarray, terms: np.ndarray, impact: np.ndarray, vocabulary: int):
        self.ids, self.starts, self.terms, self.impact = doc_ids, starts, terms, impact
        owner = np.repeat(np.arange(len(doc_ids)), np.diff(starts))
        order = np.lexsort((-impact, terms))
        self.docs, self.sorted_impact = owner[order], impact[order]
        self.lists = np.searchsorted(terms[order], np.arange(vocabulary + 1))
        self.weights = np.zeros(vocabulary, "i8")  # of the running query
        self.seen = np.zeros(len(doc_ids), bool)

    def scores(self, docs: np.ndarray) -> np.ndarray:
        """Random access: the exact scores of documents, each with a posting at least, by their forward entries."""
        n = self.starts[docs + 1] - self.starts[docs]
        first = np.cumsum(n) - n
        at = np.arange(int(n.sum())) - np.repeat(first - self.starts[docs], n)
        return np.add.reduceat(self.weights[self.terms[at]] * self.impact[at], first)

    def search(self, terms: np.ndarray, weights: np.ndarray, best: tuple[np.ndarray, np.ndarray], k: int, step: int = 16) -> tuple[tuple[np.ndarray, np.ndarray], int]:
        """The k best (ids, scores) of the best so far and this shard, and how many documents were scored."""
        self.weights[terms] = weights
        low, high = self.lists[terms], self.lists[terms + 1]
        depth, longest, met = 0, int((high - low).max(initial=0)), []
        while depth < longest:
            upto = np.minimum(low + depth + step, high)
            n = np.maximum(upto - low - depth, 0)
            at = np.arange(int(n.sum())) + np.repeat(low + depth - (np.cumsum(n) - n), n)  # sorted access, all lists to the same depth
            new = np.unique(self.docs[at])
            new = new[~self.seen[new]]
            depth += step
            if len(new):
                self.seen[new] = True
                met.append(new)
                score = self.scores(new)
                best = top(np.concatenate([best[0], self.ids[new]]), np.concatenate([best[1], score]), k)
            more = low + depth < high
            last = self.sorted_impact[np.minimum(low + depth - 1, len(self.docs) - 1)]
            threshold = int((weights * last)[more].sum())  # a list that has ended has nothing unseen
            if not more.any() or len(best[1]) == k and threshold < best[1][-1]:
                break
            step = min(2 * step, 1 << 10)
        self.weights[terms] = 0
        scored = np.concatenate(met) if met else np.zeros(0, "i8")
        self.seen[scored] = False
        return best, len(scored)


def top(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best above zero, equal scores by ascending id."""
    if len(scores) > 4 * k:
        some = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        ids, scores = ids[some], scores[some]
    order = np.lexsort((ids, -scores))[:k]
    order = order[scores[order] > 0]
    return ids[order], scores[order]


NULL_ID = np.iinfo("i8").max  # sorts last; given back as null


def _searched(queries: list[tuple[np.ndarray, np.ndarray]], n_docs: int, total: int, vocabulary: int, k: int, shard_postings: int):
    """Rows (query, doc_id, score): each query's best within a task's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, "i8"), np.zeros(0, "i8")) for _ in queries]

        def flush(held: list[tuple]) -> None:
            ids, n_terms, sizes, terms, counts = (np.concatenate(x) for x in zip(*held))
            m = np.fromiter((length_factor(x, n_docs, total) for x in n_terms.tolist()), "i8", len(n_terms))
            shard = Shard(ids, np.concatenate([[0], np.cumsum(sizes)]), terms, impacts(counts, np.repeat(m, sizes)), vocabulary)
            for q, (own, weights) in enumerate(queries):
                best[q], _ = shard.search(own, weights, best[q], k)

        held, size = [], 0
        for batch in batches:
            doc_id, n_terms, terms, counts = batch.columns
            sizes = np.diff(terms.offsets.to_numpy())
            some = sizes > 0  # a document without any query's term can't score
            if not some.any():
                continue
            ids = np.where(np.asarray(doc_id.is_null()), NULL_ID, doc_id.fill_null(0).to_numpy())
            held.append((ids[some], n_terms.to_numpy()[some], sizes[some], terms.flatten().to_numpy(), counts.flatten().to_numpy()))
            size += len(held[-1][3])
            if size >= shard_postings:
                flush(held)
                held, size = [], 0
        if held:
            flush(held)
        of = np.repeat(np.arange(len(queries), dtype="i4"), [len(x[0]) for x in best])
        ids = np.concatenate([x[0] for x in best])
        yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(ids, mask=ids == NULL_ID), pa.array(np.concatenate([x[1] for x in best]))], names=["query", "doc_id", "score"])

    return run


def search(docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text", query_id_col: str = "item_id", query_text_col: str = "text", k: int = K, block_bytes: int = BLOCK_BYTES, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """The k best documents of each query with a score above zero: item_id, rank (from 1), doc_id, score.

    Terms are runs of letters, digits and all that isn't ASCII, A-Z made small; null and empty texts have none. Rows of
    one query id (null, too) are one query, which takes each term once; a query without terms gives no row. Every row of docs
    is a document: repeated ids rank as often as they stand, null ids after all others of their score. Other columns are
    left out. Empty tables give an empty result. Queries beyond block_bytes of terms are searched in as many passes.
    """
    spark, found = docs.sparkSession, []
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    for block in query_blocks(queries, query_id_col, query_text_col, block_bytes):
        vocabulary = sorted({t for _, terms in block for t in terms})
        index = kept(forward_index(rows, vocabulary), "forward")
        n_docs, total, df = statistics(index, len(vocabulary))
        if not n_docs:
            continue
        place = {t: i for i, t in enumerate(vocabulary)}
        weights = np.array([weight(n_docs, x) for x in df], "i8")
        held = np.array(df) > 0
        asked = [np.array([place[t] for t in terms if held[place[t]]], "i8") for _, terms in block]
        task = _searched([(own, weights[own]) for own in asked], n_docs, total, len(vocabulary), k, shard_postings)
        local = map_arrow(index, task, "query int, doc_id long, score long").withColumn("bucket", F.spark_partition_id() % 64)
        order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        for keys in (["query", "bucket"], ["query"]):
            local = local.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
        ids = spark.createDataFrame([(q, ident) for q, (ident, _) in enumerate(block)], "query int, item_id long")  # one row a query of the block
        found.append(kept(local.join(F.broadcast(ids), "query").select("item_id", "rank", "doc_id", "score"), "ranked"))
        dropped(index)
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for df in found:
        out = out.unionByName(df)
    return out


def op13_threshold_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of each benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
a AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM n),
f AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, a GROUP BY term, docs),
s AS (
  SELECT item_id, f.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n.n * docs) // total)))) AS BIGINT) AS score
  FROM f JOIN n USING (doc_id) JOIN w USING (term) JOIN q USING (term), a GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0
QUALIFY rank <= 50
"""

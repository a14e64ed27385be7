"""Filter interaction audit over packed bitmap indexes.

Each task turns its rows, block by block, into bitsets: one for membership, one for each filter's failures and one for
each label. A part's rows lie together on 64-bit words of their own, so one pass over a bitset counts all parts. For
every set of filters that may stand before another, the survivors are the members AND NOT the failures of the set, and
population counts of what they share with the next filter and the labels are the block's cells. Cells add up over blocks
and tasks; every order of the filters then reads its steps from the summed cells, so no row is looked at twice.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm.common import add_columns, kept, map_arrow, table
from claimloom.llm.simhash import word_blocks

FILTERS = "ABCDE"
CAPITALS, SIGNS = bytes(range(65, 91)), re.compile(rb"[#$%&*|]")
BLOCK_ROWS = 1 << 18


def text_failures(text: str | None) -> int:
    """Bits 0 to 3: under 200 words; under half of the words distinct; over 2 % capitals; a sign of #$%&*|. Null is the empty text."""
    text = text or ""
    raw, n, distinct = text.encode(), 0, set()
    for words in word_blocks(raw):
        n += len(words)
        distinct.update(words)
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    return (n < 200) | (100 * len(distinct) < 50 * n) << 1 | (100 * capitals > 2 * len(text)) << 2 | (SIGNS.search(raw) is not None) << 3


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, failures (bit k for filter k of ABCDE), good and toxic for each document.

    E fails where a smaller doc_id has the same text; a null doc_id is neither smaller nor has one. Texts are the same
    if their 128-bit digests are. Of several labels of a doc_id any that says 1 counts.
    """

    def start():
        def made(texts):
            return [[text_failures(t) for t in texts], [hashlib.blake2b((t or "").encode(), digest_size=16).digest() for t in texts]]

        return made

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.col("text").cast("string").alias("text"))
    looked = kept(add_columns(rows, ["text"], "failures int, digest binary", start).drop("text"), "failures")
    # Both joins keep a row for each document; a frequent digest is met by a single row, so its rows may be split over tasks.
    repeated = looked.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    says = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality").eqNullSafe(1)).alias("good"), F.max(F.col("toxic").eqNullSafe(1)).alias("toxic")).where("good or toxic")
    both = looked.join(repeated, "digest", "left").join(says, "doc_id", "left")
    late = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return both.select("part", F.col("failures").bitwiseOR(F.when(late, 16).otherwise(0)).alias("failures"), F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def cells(codes: np.ndarray, failures: np.ndarray, labels: list[np.ndarray], filters: int) -> np.ndarray:
    """Counts of a block: [part, column, cell], a cell for each set of filters before another one.

    codes are 0 to n - 1, each there at least once. Columns: kept, removed, redundant, unique_fails, then rows
    removed with each label. Cells stand in the order of before_after().
    """
    rows = np.bincount(codes)
    words = -(-rows // 64)
    order = np.argsort(codes, kind="stable")
    within = np.arange(len(codes)) - np.repeat(np.cumsum(rows) - rows, rows)
    place = np.repeat((np.cumsum(words) - words) * 64, rows) + within
    segments = np.cumsum(words) - words

    def bits(flags: np.ndarray) -> np.ndarray:
        spread = np.zeros(int(words.sum()) * 64, bool)
        spread[place] = flags[order]
        return np.packbits(spread, bitorder="little").view("<u8")

    def count(bitset: np.ndarray) -> np.ndarray:
        return np.add.reduceat(np.bitwise_count(bitset).astype("i8"), segments)

    member, fails, marked = bits(np.ones(len(codes), bool)), [bits(failures >> k & 1 == 1) for k in range(filters)], [bits(x) for x in labels]
    total = [count(x) for x in fails]
    alive = {0: member}
    for before in range(1, 1 << filters):
        low = before & -before
        alive[before] = alive[before ^ low] & ~fails[low.bit_length() - 1]
    left = {before: count(x) for before, x in alive.items()}
    alone = [count(alive[(1 << filters) - 1 ^ 1 << k] & fails[k]) for k in range(filters)]
    out = []
    for before, k in before_after(filters):
        hit = alive[before] & fails[k]
        removed = count(hit)
        out.append([left[before] - removed, removed, total[k] - removed, alone[k], *(count(hit & x) for x in marked)])
    return np.array(out).transpose(2, 1, 0)


def before_after(filters: int) -> list[tuple[int, int]]:
    """Each (set of filters as bits, another filter)."""
    return [(before, k) for before in range(1 << filters) for k in range(filters) if not before >> k & 1]


def audit(rows: DataFrame, label_cols: list[str], names: str = FILTERS) -> DataFrame:
    """Every step of every order of the filters, for every part: part, filter_order, step and counts.

    rows has part (string, null is the empty one), failures (bit k set where filter k of `names` fails) and boolean
    label columns; other columns are left out. Counts are kept, removed, redundant, unique_fails, <label>_lost for each label
    and shapley, all long. A part without failures has rows of zeros; an empty table gives an empty one. Up to six
    filters, as all orders are listed.
    """
    n = len(names)
    if not 1 <= n <= 6:
        raise ValueError("one to six filters")
    pairs = before_after(n)
    counts = ["kept", "removed", "redundant", "unique_fails", *(f"{c}_lost" for c in label_cols)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            block = pa.Table.from_batches(held).combine_chunks()
            part = pc.fill_null(block["part"], "").combine_chunks().dictionary_encode()
            found = cells(part.indices.to_numpy(), block["failures"].to_numpy(), [pc.fill_null(block[c], False).to_numpy() for c in label_cols], n)
            parts = pa.array(np.repeat(np.arange(len(part.dictionary)), len(pairs)))
            keys = [part.dictionary.take(parts), *(pa.array(np.tile(np.array(x, "i4"), len(part.dictionary))) for x in zip(*pairs))]
            return pa.RecordBatch.from_arrays([*keys, *(pa.array(found[:, i].ravel()) for i in range(len(counts)))], names=["part", "before", "filter", *counts])

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= BLOCK_ROWS:
                yield flush(held)
                held, size = [], 0
        if size:
            yield flush(held)

    schema = ", ".join(["part string", "before int", "filter int", *(f"{c} long" for c in counts)])
    found = map_arrow(rows.select("part", F.col("failures").cast("int").alias("failures"), *label_cols), run, schema)
    summed = found.groupBy("part", "before", "filter").agg(*(F.sum(c).alias(c) for c in counts))
    # In |S|! (n - 1 - |S|)! orders exactly the filters S stand before a given one.
    ahead = F.bit_count("before")
    weight = F.element_at(F.array(*(F.lit(factorial(k) * factorial(n - 1 - k)) for k in range(n))), ahead + 1)
    share = summed.groupBy("part", "filter").agg(F.sum(F.col("removed") * weight).alias("shapley"))
    steps = [("".join(names[k] for k in order), i + 1, sum(1 << k for k in order[:i]), order[i]) for order in permutations(range(n)) for i in range(n)]
    orders = F.broadcast(rows.sparkSession.createDataFrame(steps, "filter_order string, step int, before int, filter int"))  # n! n rows, whatever the table
    return summed.join(share, ["part", "filter"]).join(orders, ["before", "filter"]).select("part", "filter_order", "step", *counts, "shapley")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five filters over whole documents: counts of every step of all 120 orders in every source."""
    rows = judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return audit(rows, ["good", "toxic"])


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    {'A': len(ws) < 200, 'B': 100 * len(list_distinct(ws)) < 50 * len(ws), 'C': 100 * (strlen(t) - strlen(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t),
     'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(w.doc_id > first_id, false)} AS bad
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
g AS (SELECT part, good, toxic, [k for k in ['A', 'B', 'C', 'D', 'E'] if CASE k WHEN 'A' THEN bad.A WHEN 'B' THEN bad.B WHEN 'C' THEN bad.C WHEN 'D' THEN bad.D ELSE bad.E END] AS fails, count(*) AS n FROM f GROUP BY ALL),
k AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS k),
o AS (SELECT a.k || b.k || c.k || d.k || e.k AS filter_order FROM k a, k b, k c, k d, k e WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
s AS (SELECT filter_order, step, filter_order[step] AS k, string_split(left(filter_order, step - 1), '') AS before FROM o, (SELECT unnest(range(1, 6)) AS step)),
c AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, k,
    coalesce(sum(n) FILTER (NOT list_contains(fails, k) AND NOT list_has_any(fails, before)), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (list_contains(fails, k) AND NOT list_has_any(fails, before)), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (list_contains(fails, k) AND list_has_any(fails, before)), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails = [k]), 0)::BIGINT AS unique_fails,
    coalesce(sum(n) FILTER (good AND list_contains(fails, k) AND NOT list_has_any(fails, before)), 0)::BIGINT AS good_lost,
    coalesce(sum(n) FILTER (toxic AND list_contains(fails, k) AND NOT list_has_any(fails, before)), 0)::BIGINT AS toxic_lost
  FROM g, s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, k) AS BIGINT) AS shapley FROM c
"""

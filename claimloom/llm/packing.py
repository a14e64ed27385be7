"""Packing token sequences by Karmarkar-Karp multiway differencing.

Documents are packed where they lie: each task takes its partition's documents in order, in blocks of a fixed number
of tokens (a longer document goes on in the next block), so nothing is shuffled and a task run again gives the same windows. Documents are cut into parts of at most
`part_tokens`, and all parts are dealt by differencing: partial partitions with opposing imbalances merge, largest
spread first, until one partition into near-equal windows is left. If its fullest window is over capacity, the block
is partitioned again with one more window.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from claimloom.llm.common import map_arrow, table
from claimloom.llm.pieces import byte_balanced, encoder, vocabulary

END_ID = 1
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, padded long, ids binary"


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Indexes of `sizes` dealt into `windows` near-equal lists by the largest differencing method.

    A partial partition is a vector of window sums, in ascending order. The two with the largest spread merge,
    the fullest windows of one with the emptiest of the other. Ties go by age, so the result is fixed.
    """
    if windows == 1:
        return [list(range(len(sizes)))]
    heap = []
    for i, n in enumerate(sizes):
        sums = np.zeros(windows, "i8")
        sums[-1] = n
        heap.append((-n, i, sums, {windows - 1: (i, None, None)}))
    heapq.heapify(heap)
    age = len(sizes)
    while len(heap) > 1:
        _, _, a, held_a = heapq.heappop(heap)
        _, _, b, held_b = heapq.heappop(heap)
        sums = a + b[::-1]
        order = np.argsort(sums, kind="stable")
        place = np.empty(windows, "i8")
        place[order] = np.arange(windows)
        if len(held_b) > len(held_a):  # the smaller mapping moves into the larger
            held = {int(place[windows - 1 - w]): x for w, x in held_b.items()}
            for w, x in held_a.items():
                k = int(place[w])
                held[k] = (None, x, held[k]) if k in held else x
        else:
            held = {int(place[w]): x for w, x in held_a.items()}
            for w, x in held_b.items():
                k = int(place[windows - 1 - w])
                held[k] = (None, x, held[k]) if k in held else x
        sums = sums[order]
        heapq.heappush(heap, (-int(sums[-1] - sums[0]), age, sums, held))
        age += 1
    out: list[list[int]] = []
    for tree in heap[0][3].values() if heap else ():
        found, stack = [], [tree]
        while stack:
            i, left, right = stack.pop()
            if i is None:
                stack += [left, right]
            else:
                found.append(i)
        out.append(sorted(found))
    return sorted(out)


def pack_block(lengths: list[int], capacity: int, part_tokens: int) -> list[tuple[list[tuple[int, int, int]], int]]:
    """Windows of one block: each a list of (document, start, length) in order, and its sum of at most `capacity`."""
    windows: list[tuple[list[tuple[int, int, int]], int]] = []
    parts = [(d, at, min(part_tokens, n - at)) for d, n in enumerate(lengths) for at in range(0, n, part_tokens)]
    if not parts:
        return windows
    sizes = [p[2] for p in parts]
    count = -(-sum(sizes) // capacity)
    while True:
        dealt = differencing(sizes, count)
        if max(sum(sizes[i] for i in w) for w in dealt) <= capacity:
            break
        count += 1
    for w in dealt:
        joined: list[tuple[int, int, int]] = []
        for d, at, n in (parts[i] for i in w):
            if joined and joined[-1][0] == d and joined[-1][1] + joined[-1][2] == at:  # neighbours again
                joined[-1] = (d, joined[-1][1], joined[-1][2] + n)
            else:
                joined.append((d, at, n))
        windows.append((joined, sum(x[2] for x in joined)))
    return windows


def pack(df: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = END_ID, part_tokens: int = 512, block_tokens: int = 128 * 2048 - 1024, batch_bytes: int = 4 << 20) -> DataFrame:
    """One row for each piece of a packed window, with its ids as little-endian unsigned 32-bit integers.

    doc_id, start (its document's ids before it), length, doc_tokens (with the end id), sequence_id, offset
    (gapless from 0 in its window), padded (the window's length after padding: itself at a power of two, else
    capacity), ids. Null texts are empty and still give the end id. Null document ids stay null. Repeated
    rows are packed each. Other columns are left out. An empty table gives no windows. sequence_id holds the
    partition in its upper bits: unique, not gapless. A worker holds block_tokens and batch_bytes at most, besides
    the longest text. Clashing names make no difference: only the two columns named are read.
    """
    path = path or vocabulary("word_bpe_49k.json")
    end = np.array([end_id], "<u4")

    schema = to_arrow_schema(T.StructType.fromDDL(PIECES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        enc, sequence = encoder(path), TaskContext.get().partitionId() << 40
        held: list[tuple[int | None, int, int, np.ndarray]] = []  # a document, its ids before this stretch, all its ids, the stretch
        tokens = 0

        def flush() -> pa.RecordBatch:
            nonlocal sequence, held, tokens
            rows = []
            for pieces, total in pack_block([len(x[3]) for x in held], capacity, part_tokens):
                offset, padded = 0, total if total & (total - 1) == 0 else capacity
                for d, at, n in pieces:
                    doc, before, whole, ids = held[d]
                    rows.append((doc, before + at, n, whole, sequence, offset, padded, ids[at : at + n].tobytes()))
                    offset += n
                sequence += 1
            held, tokens = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for batch in batches:
            docs, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for part in byte_balanced(texts, batch_bytes):
                ids, at = enc.encode(texts[part])
                for doc, a, b in zip(docs[part], at[:-1].tolist(), at[1:].tolist()):
                    own, done = np.concatenate([ids[a:b].astype("<u4"), end]), 0
                    while done < len(own):  # a document that doesn't fit goes on in the next block
                        some = own[done : done + block_tokens - tokens]
                        held.append((doc, done, len(own), some))
                        done, tokens = done + len(some), tokens + len(some)
                        if tokens >= block_tokens:
                            yield flush()
        if held:
            yield flush()

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.transform(map_arrow, run, PIECES)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens of the word vocabulary."""
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")

"""SimHash near-duplicates by tiled exact comparison.

Each text gets a 64-bit fingerprint of its word shingles; equal fingerprints collapse first. Two fingerprints
within `radius` bits agree on all but `radius` of radius + 2 bit blocks, so every pair of blocks they agree on is
a bucket they share: comparing within buckets loses no link. Inside a bucket of any size fingerprints are compared in
numpy tiles by exclusive-or and bit counts, and tile pairs whose population counts differ beyond the radius are skipped.
A bucket over `tile_rows` is itself split into tiles by population count and hash, so no task holds more than two
tiles of it. A tile pair gives a spanning forest of its links, never all pairs. Components come from alternating
star contraction over tables in the shared folder.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm.common import add_columns, dropped, kept, map_arrow, table

BLANK = re.compile(rb"[\x20\x09-\x0d]")


def word_blocks(raw: bytes, block_bytes: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of raw in lists of bounded size."""
    at = 0
    while at < len(raw):
        m = BLANK.search(raw, at + block_bytes) if at + block_bytes < len(raw) else None
        end = m.start() if m else len(raw)
        yield raw[at:end].split()
        at = end


def shingle_hashes(words: list[bytes], width: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each run of `width` words, joined by single spaces."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    text = b" ".join(words)
    lengths = np.fromiter(map(len, words), "i8", len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    return np.array([digest(text[a:b], seed) for a, b in zip(starts.tolist(), ends[width - 1 :].tolist())], "<u8")


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="i8")


def fingerprint(text: str | None, width: int = 3) -> int:
    """The unsigned fingerprint of a whole text: each bit is set if set in over half of the shingle hashes."""
    counts, n, carry = np.zeros(64, "i8"), 0, []
    for words in word_blocks((text or "").encode().lower()):  # lower() of bytes changes A-Z only
        words = carry + words
        if len(words) >= width:
            h = shingle_hashes(words, width)
            for i in range(0, len(h), 1 << 15):
                counts += bit_counts(h[i : i + (1 << 15)])
            n += len(h)
            words = words[len(words) - width + 1 :]
        carry = words
    if not n:
        if not carry:
            return 0
        counts, n = bit_counts(shingle_hashes(carry, len(carry))), 1
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, text_col: str = "text", width: int = 3) -> DataFrame:
    """df with `fp`, the fingerprint as a signed long."""

    def start():
        def made(texts):
            return [np.array([fingerprint(t, width) for t in texts], "u8").view("i8")]

        return made

    return add_columns(df, [text_col], "fp long", start)


def close_pairs(groups: np.ndarray, fps: np.ndarray, radius: int, tile: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs within `radius` bits in groups of rows that lie together.

    Each group's rows are cut into tiles in the order of their population counts. Tiles are compared all with all by
    exclusive-or and bit counts, many tile pairs in one step, but for pairs whose population counts differ by more
    than the radius. Groups of over 64 rows are cut into tiles of 32 times the size.
    """
    ones = np.bitwise_count(fps).astype("i4")
    order = np.lexsort((ones, groups))
    groups, fps, ones = groups[order], fps[order], ones[order]
    bounds = np.concatenate([[0], np.flatnonzero(np.diff(groups)) + 1, [len(groups)]])
    left, right = [np.zeros(0, "i8")], [np.zeros(0, "i8")]
    for wide, side in ((False, tile), (True, 32 * tile)):
        mine = ((np.diff(bounds) > 64) == wide) & (np.diff(bounds) > 1)
        starts, ends = bounds[:-1][mine], bounds[1:][mine]
        n = -(-(ends - starts) // side)
        of = np.repeat(np.arange(len(n)), n)  # each tile's group
        low = starts[of] + side * (np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n))
        high = np.minimum(low + side, ends[of])
        at, step, grid = np.arange(len(of)), 0, np.arange(side)
        while len(at):
            at = at[at + step < len(of)]
            at = at[(of[at] == of[at + step])]
            at = at[ones[low[at + step]] - ones[high[at] - 1] <= radius]  # a tile too far away leaves, as all later ones are farther
            for i in range(0, len(at), max(1, (1 << 20) // side**2)):
                a, b = at[i : i + max(1, (1 << 20) // side**2)], at[i : i + max(1, (1 << 20) // side**2)] + step
                x, y = low[a][:, None] + grid, low[b][:, None] + grid
                near = np.bitwise_count(fps[np.minimum(x, len(fps) - 1)][:, :, None] ^ fps[np.minimum(y, len(fps) - 1)][:, None, :]) <= radius
                k, p, q = np.nonzero(near)
                x, y = x[k, p], y[k, q]
                keep = (x < y) & (x < high[a][k]) & (y < high[b][k])
                left.append(order[x[keep]])
                right.append(order[y[keep]])
            step += 1
    return np.concatenate(left), np.concatenate(right)


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest reachable position of each of n positions."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if (label == before).all():
            return label


def _linked(radius: int):
    """Links within groups of rows (group, fp) that arrive sorted by group: (a, b) with b the smaller root."""

    def links(groups: np.ndarray, fps: np.ndarray) -> pa.RecordBatch | None:
        nodes, at = np.unique(fps, return_inverse=True)
        x, y = (at[side] for side in close_pairs(groups, fps, radius))
        root = forest(len(nodes), x, y)
        child = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[child].view("i8")), pa.array(nodes[root[child]].view("i8"))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, fps = np.zeros(0, "i8"), np.zeros(0, "u8")
        for batch in batches:
            groups = np.concatenate([groups, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy().view("u8")])
            whole = int(np.searchsorted(groups, groups[-1])) if len(groups) else 0  # the last group may go on
            if whole >= 20_000:
                if (out := links(groups[:whole], fps[:whole])) is not None:
                    yield out
                groups, fps = groups[whole:], fps[whole:]
        if len(groups) and (out := links(groups, fps)) is not None:
            yield out

    return run


def links(distinct: DataFrame, radius: int = 2, tile_rows: int = 2048) -> DataFrame:
    """A spanning set (a, b) of the links among distinct fingerprints `fp`."""
    blocks = radius + 2
    width = 64 // blocks
    part = [F.shiftrightunsigned("fp", width * i).bitwiseAND(F.lit((1 << (width if i < blocks - 1 else 64 - width * i)) - 1)) for i in range(blocks)]
    keys = [F.xxhash64(F.lit(k), *(part[i] for i in pair)) for k, pair in enumerate(combinations(range(blocks), 2))]
    keyed = distinct.select("fp", F.explode(F.array(*keys)).alias("bucket"))
    sizes = keyed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    rows = keyed.join(sizes, "bucket").withColumn("ones", F.bit_count("fp"))
    one = rows.where(F.col("n") <= tile_rows).select(F.col("bucket").alias("grp"), "fp")
    cut = F.ceil(F.col("n") / F.lit(tile_rows)).cast("int")
    tiles = rows.where(F.col("n") > tile_rows).withColumn("cut", cut).withColumn("own", F.col("ones") * F.col("cut") + F.pmod(F.xxhash64("fp"), F.col("cut")).cast("int"))
    low, high = (F.greatest(F.lit(0), F.col("ones") - radius)) * F.col("cut"), (F.least(F.lit(64), F.col("ones") + radius) + 1) * F.col("cut") - 1
    paired = tiles.select("bucket", "fp", "own", F.explode(F.sequence(low, high)).alias("other"))
    many = paired.select(F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("grp"), "fp")
    grouped = one.unionByName(many)
    return grouped.repartition("grp").sortWithinPartitions("grp").transform(map_arrow, _linked(radius), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node reachable. Roots are rows too.

    Alternates large and small stars until a round changes nothing; each round is a table in the shared folder.
    """
    now = kept(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "stars")
    mark = lambda df: tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
    state = mark(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        old, now = now, kept(small, "stars")
        after = mark(now)
        dropped(old)
        if after == state:
            break
        state = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 2, tile_rows: int = 2048) -> DataFrame:
    """One row for each row of df: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest document id reachable over links, the row's own included. Texts without words
    (null, empty, blank) have fingerprint zero and are linked like any other. A text of fewer than `width`
    words is one shingle. Repeated rows each give a row. Null ids get a component_id if a row with an id is
    reachable, else null. Other columns are left out. An empty table gives an empty one.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = kept(fingerprints(rows, "text", width).select("doc_id", "fp"), "fingerprints")
    distinct = kept(docs.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    group = components(links(distinct, radius, tile_rows))
    joined = distinct.join(group, distinct["fp"] == group["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    named = joined.join(smallest, "root").select("fp", "component_id")
    return docs.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of df whose id is their component's: one document of each group of near copies, columns as they are.

    Rows that share the kept id all stay, as do rows of groups without any id.
    """
    found = near_duplicates(df, id_col, text_col, **how)
    keep = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("kept_id__")).distinct()
    return df.join(keep, F.col(id_col).cast("long").eqNullSafe(F.col("kept_id__")), "left_semi")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and components of all documents: three-word shingles, links at two or fewer differing bits."""
    return near_duplicates(table(spark, sf_dir, "documents"))

"""Near copies by the exact similarity of shingle sets, for the pipeline.

Each text gives its set of five-word shingles, by hash; equal sets collapse first. Of each set the smallest hashes
are its keys, as many as two sets of the similarity can't both miss, up to KEYS: sets with fewer than 80 shingles
always share a key, larger ones miss each other with a chance of at most 0.2 ** KEYS. Sets that share a key are
compared in numpy tiles by exclusive-or of their fingerprints, with a radius over four standard deviations beyond that
of the similarity, by size, and by the bytes that two sets share in 256 classes of hashes, with as much room; the pairs
left are verified by the exact Jaccard similarity of the whole sets before they link.

Only what a group joins counts, so the pairs of a large group are never all made: first every set is verified against
its nearest in a few of its keys' tiles, which joins most of a group in a number of pairs linear in its size; then all
candidate pairs of sets that are still in different groups are verified, which leaves no link out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import add_columns, dropped, kept, map_arrow, set_aside, sifted
from claimloom.llm.simhash import bit_counts, close_pairs, components, shingle_hashes, word_blocks

WIDTH, SIMILARITY, RADIUS, KEYS, BINS = 5, 0.8, 22, 16, 256
SURE = 4.5  # standard deviations that an estimate may fall short of the similarity
FIRST = 4  # keys of the first round


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The sorted distinct shingle hashes of a whole text; one of fewer than `width` words is one shingle."""
    found, carry = [], []
    for words in word_blocks((text or "").encode().lower()):
        words = carry + words
        if len(words) >= width:
            found.append(np.unique(shingle_hashes(words, width)))
            words = words[len(words) - width + 1 :]
        carry = words
    if not found and carry:
        found.append(shingle_hashes(carry, len(carry)))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, "u8")


def set_name(hashes: np.ndarray) -> int:
    import xxhash

    return int(np.array(xxhash.xxh64_intdigest(hashes.tobytes(), 42), "u8").view("i8"))


def set_print(hashes: np.ndarray) -> int:
    """The fingerprint of a set as a signed long: each bit is set if set in over half of the hashes."""
    counts = sum((bit_counts(hashes[i : i + (1 << 15)]) for i in range(0, len(hashes), 1 << 15)), np.zeros(64, "i8"))
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def set_bins(hashes: np.ndarray) -> bytes:
    """One byte of the smallest hash in each of BINS classes, zero for an empty class: two sets agree in about as many as they are similar."""
    out = np.zeros(BINS, "u1")
    out[(hashes[::-1] % BINS).astype("i8")] = 1 + (hashes[::-1] // BINS) % 255  # hashes ascend, so the smallest is written last
    return out.tobytes()


def prefix(size: int, similarity: float) -> int:
    """How many of a set's smallest hashes can't all be missing from a set of the similarity."""
    return size - math.ceil(similarity * size - 1e-9) + 1 if size else 0


def _candidates(radius: int, similarity: float, nearest: bool):
    """Pairs (a, b) of rows (grp, node, fp, n, bins, comp, side, before) that arrive sorted by grp: within the radius, of sizes and bins that allow the similarity, and of different comps.

    Rows of one side, from zero on, meet in another group. Each row names in `before` its keys ahead of the group's:
    two rows that share one of them meet there, so a pair is given once, however many keys it shares. With `nearest` each row gives at most one pair in its group, that with the nearest row before it.
    """

    def pairs(groups: np.ndarray, nodes: np.ndarray, fps: np.ndarray, n: np.ndarray, bins: np.ndarray, comps: np.ndarray, sides: np.ndarray, before: np.ndarray, many: np.ndarray) -> pa.RecordBatch:
        x, y = close_pairs(groups, fps, radius)
        keep = (comps[x] != comps[y]) & ((sides[x] < 0) | (sides[x] != sides[y])) & (np.minimum(n[x], n[y]) >= similarity * np.maximum(n[x], n[y]) - 1e-9)
        x, y = x[keep], y[keep]
        alike = np.zeros(len(x))
        for i in range(0, len(x), 1 << 14):
            a, b = bins[x[i : i + (1 << 14)]], bins[y[i : i + (1 << 14)]]
            used = np.maximum(((a | b) != 0).sum(1), 1)
            share = ((a == b) & (a != 0)).sum(1) / used
            union = (n[x[i : i + (1 << 14)]] + n[y[i : i + (1 << 14)]]) / (1 + similarity)  # of which `used` are a sample without repeats
            spread = np.sqrt(similarity * (1 - similarity) / used * np.maximum(1 - used / np.maximum(union, 1), 0))
            alike[i : i + (1 << 14)] = np.where(share >= similarity - SURE * spread - 0.02, share, -1)
        keep = alike >= 0
        x, y, alike = x[keep], y[keep], alike[keep]
        fresh = np.ones(len(x), "?")
        for i in range(0, len(x), 1 << 14):
            a, b = x[i : i + (1 << 14)], y[i : i + (1 << 14)]
            for k in range(int(many[a].max())):
                met = (before[b] == before[a, k][:, None]) & (np.arange(KEYS) < many[b][:, None])
                fresh[i : i + (1 << 14)] &= ~(met.any(1) & (k < many[a]))
        x, y, alike = x[fresh], y[fresh], alike[fresh]
        if nearest and len(x):
            x, y = np.where(nodes[x] < nodes[y], x, y), np.where(nodes[x] < nodes[y], y, x)
            order = np.lexsort((nodes[x], -alike, y))
            first = order[np.flatnonzero(np.diff(y[order], prepend=-1))]
            x, y = x[first], y[first]
        pair = np.unique(np.stack([np.minimum(nodes[x], nodes[y]), np.maximum(nodes[x], nodes[y])], 1), axis=0) if len(x) else np.zeros((0, 2), "i8")
        return pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], names=["a", "b"])

    def cut(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """Whole groups at a time, about four million comparisons or one group."""
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(held[0])) + 1, [len(held[0])]])
        work = np.cumsum(np.diff(bounds) ** 2)
        at = 0
        while at < len(work):
            to = max(at + 1, int(np.searchsorted(work, (work[at - 1] if at else 0) + 4_000_000, side="right")))
            yield pairs(*(c[bounds[at] : bounds[to]] for c in held))
            at = to

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            cols = [batch.column(c).to_numpy() for c in ("grp", "node", "fp", "n")]
            cols[2] = cols[2].view("u8")
            cols += [np.frombuffer(b"".join(batch.column("bins").to_pylist()), "u1").reshape(-1, BINS), batch.column("comp").to_numpy(), batch.column("side").to_numpy()]
            many = batch.column("before").value_lengths().to_numpy()
            before = np.zeros((len(many), KEYS), "i8")
            before[np.arange(KEYS) < many[:, None]] = batch.column("before").flatten().to_numpy()
            cols += [before, many]
            held = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
            whole = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0  # the last group may go on
            if whole >= 20_000:
                yield from cut([x[:whole] for x in held])
                held = [x[whole:] for x in held]
        if held is not None and len(held[0]):
            yield from cut(held)

    return run


def _similar(similarity: float):
    """Of rows (a, b, set_a, set_b) the pairs of the Jaccard similarity or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = (np.frombuffer(s.as_buffer(), "<u8") for s in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(both / (len(x) + len(y) - both) >= similarity)
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def verified(pairs: DataFrame, distinct: DataFrame, rows: DataFrame, width: int, similarity: float) -> DataFrame:
    """Those of the pairs (a, b) with the similarity, in a table. Sets are made again of the texts of `rows` (text, hash), for the pairs' nodes alone."""
    pairs = kept(pairs.distinct(), "candidates")
    named = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = kept(distinct.select("node", "hash").join(named, "node", "left_semi").select("hash"), "wanted")

    def start():
        def made(texts):
            sets = [shingle_set(t, width) for t in texts]
            return [[set_name(s) for s in sets], [s.tobytes() for s in sets]]

        return made

    sets = kept(add_columns(sifted(rows, "hash", wanted).join(wanted, "hash").dropDuplicates(["hash"]).select("text"), ["text"], "node long, hashes binary", start).select("node", "hashes").dropDuplicates(["node"]), "hashes")
    sides = [sets.select(F.col("node").alias(s), F.col("hashes").alias(f"set_{s}")) for s in "ab"]
    found = kept(pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "set_a", "set_b").transform(map_arrow, _similar(similarity), "a long, b long"), "similar")
    for table in (pairs, wanted, sets):
        dropped(table)
    return found


def similar_sets(rows: DataFrame, sketches: DataFrame, width: int, similarity: float, radius: int, tile_rows: int) -> DataFrame:
    """A spanning set (a, b) of the links among the sets of `rows` (text, hash), whose sketches are given."""
    distinct = kept(sketches.dropDuplicates(["node"]).select("node", "hash", "fp", "n", "bins", "keys"), "sets")
    cut = F.ceil(F.col("rows") / F.lit(tile_rows)).cast("int")

    def near(keyed: DataFrame, nearest: bool) -> DataFrame:
        return keyed.repartition("grp").sortWithinPartitions("grp").transform(map_arrow, _candidates(radius, similarity, nearest), "a long, b long")

    shape = distinct.select("node", "fp", "n", "bins")

    # Each key's rows in tiles that are compared within themselves; tiles differ from key to key, so that groups join over them.
    # Nodes and keys alone find what is to be compared; fingerprints and bins then come by node, for those alone.
    few = distinct.select("node", F.explode(F.slice("keys", 1, FIRST)).alias("key"))
    sizes = kept(few.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1"), "sizes")
    tiled = few.join(sizes, "key").select(F.xxhash64("key", F.pmod(F.xxhash64("node", "key"), cut)).alias("grp"), "node")
    tiled = tiled.join(shape, "node").select("grp", "node", "fp", "n", "bins", F.col("node").alias("comp"), F.lit(-1).alias("side"), F.array().cast("array<bigint>").alias("before"))
    joined = verified(near(tiled, True), distinct, rows, width, similarity)
    dropped(sizes)
    group = components(joined).withColumnRenamed("node", "linked")
    # What is still apart: keys that more than one group has, all tiles against all.
    named = kept(distinct.join(group, F.col("node") == F.col("linked"), "left").select("node", "keys", F.coalesce("root", "node").alias("comp")), "joined")
    keyed = named.select("node", "comp", F.posexplode("keys").alias("at", "key"))
    open_ = kept(keyed.groupBy("key").agg(F.count("*").alias("rows"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("key", "rows"), "open")
    tiled = keyed.join(open_, "key").withColumn("cut", cut).withColumn("tile", F.pmod(F.xxhash64("node", F.lit(1)), F.col("cut")).cast("int"))
    paired = tiled.select("key", "node", "comp", "at", "tile", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)).alias("other"))
    grouped = paired.select(F.xxhash64("key", F.least("tile", "other"), F.greatest("tile", "other")).alias("grp"), "node", "comp", F.when(F.col("tile") == F.col("other"), -1).otherwise(F.col("tile")).alias("side"), "at")
    grouped = grouped.join(shape.join(named.select("node", "keys"), "node"), "node").withColumn("before", F.slice("keys", F.lit(1), F.col("at"))).drop("keys", "at")
    rest = verified(near(grouped, False), distinct, rows, width, similarity)
    for table in (distinct, named, open_):
        dropped(table)
    return joined.unionByName(rest)


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, similarity: float = SIMILARITY, radius: int = RADIUS, tile_rows: int = 2048) -> DataFrame:
    """One row of each group of near copies, columns as they are, whatever their names.

    Groups are what links of the similarity or more join. A link between sets of 80 or more shingles can be missed by
    chance: at most 0.2 ** 16 for want of a common key, and where a fingerprint or a sample of 256 classes is over four
    standard deviations off; sets of fewer shingles always share a key. Texts without words (null, empty, blank) are one group.
    The row with the smallest id stays, null ids last; of rows of one id the one with the smallest text hash, and
    of rows of one id and text any one. An empty table gives an empty one.
    """
    df, back = set_aside(df, ["id__", "hash__", "rows", "stays"])
    mark = F.xxhash64(F.col(text_col).cast("string"))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), mark.alias("hash"))

    def start():
        def made(texts):
            out: list[list] = [[] for _ in range(5)]
            for t in texts:
                s = shingle_set(t, width)
                for o, v in zip(out, (set_name(s), set_print(s), len(s), set_bins(s), s[: min(KEYS, prefix(len(s), similarity))].view("i8").tolist())):
                    o.append(v)
            return out

        return made

    sketches = kept(add_columns(rows, ["text"], "node long, fp long, n int, bins binary, keys array<bigint>", start).drop("text"), "sketches")
    group = components(similar_sets(rows, sketches, width, similarity, radius, tile_rows)).withColumnRenamed("node", "linked")
    named = sketches.join(group, F.col("node") == F.col("linked"), "left").select("id", "hash", F.coalesce("root", "node").alias("root"))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "hash")
    keys = named.groupBy("root", "id", "hash").agg(F.count("*").alias("rows"))
    firsts = keys.groupBy("root").agg(F.min(order).alias("first"), F.sum("rows").alias("all")).where(F.col("all") > 1)
    marked = keys.join(firsts, "root").select(F.col("id").alias("id__"), F.col("hash").alias("hash__"), "rows", (order == F.col("first")).alias("stays"))
    marked = kept(marked.where("not stays or rows > 1"), "copies")  # of these no row stays as it is; the kept ones of many rows are added once
    same = F.col(id_col).cast("long").eqNullSafe(F.col("id__")) & (mark == F.col("hash__"))
    alone = df.join(marked, same, "left_anti")
    repeated = df.join(marked.where("stays"), same, "left_semi").withColumn("hash__", mark).dropDuplicates([id_col, "hash__"]).drop("hash__")
    return back(alone.unionByName(repeated))

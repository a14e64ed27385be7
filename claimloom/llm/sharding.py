"""Sharding along a Hilbert curve.

Metadata columns are quantised by rank, their bins become a point, and rows are sorted by the point's index on
the curve: neighbours on the curve are near in every dimension. Cutting the order into runs of near-equal bytes
gives shards, and files, whose value ranges are narrow in all dimensions at once, so a reader prunes by any of them.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm.common import dropped, kept, map_arrow, new_path, nullable, table

SHARDS = 8


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of points (rows, dimensions) with `bits` bits each; bits x dimensions <= 63."""
    x = [c.astype("i8") for c in points.T]
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for i in range(dims):
            high = (x[i] & bit) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & below)
            x[0] = x[0] ^ np.where(high, below, swap)
            x[i] = x[i] ^ swap if i else x[0]
    for i in range(1, dims):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] & (1 << level)) != 0, (1 << level) - 1, 0)
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for c in x:
            index = (index << 1) | (((c ^ turn) >> level) & 1)
    return index


def dimension(df: DataFrame, name: str) -> tuple[Column, bool]:
    """A column in its own order as a double, or as a string (True)."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("double"), False
    if isinstance(kind, (T.NumericType, T.BooleanType, T.TimestampType)):
        return F.col(name).cast("double"), False
    return F.col(name).cast("string"), True


def string_bounds(rows: DataFrame, name: str, bins: int) -> list[str]:
    """The bins - 1 bounds of near-equal counts among whole strings; a frequent string is as many bounds as its rows fill.

    Distinct values are ranked in range partitions, each beginning where the counts of those before end; only bounds
    reach the driver.
    """
    counts = rows.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("v")).agg(F.count("*").alias("n"))
    ranked = kept(counts.repartitionByRange("v").withColumn("run", F.spark_partition_id()), "values")
    own = F.sum("n").over(Window.partitionBy("run").orderBy("v"))
    # One row for each range.
    ahead = ranked.groupBy("run").agg(F.sum("n").alias("s")).select("run", (F.sum("s").over(Window.orderBy("run")) - F.col("s")).alias("ahead"), F.sum("s").over(Window.partitionBy()).alias("total"))
    ends = ranked.withColumn("end", own).join(F.broadcast(ahead), "run").withColumn("end", F.col("end") + F.col("ahead"))
    spans = ends.select("v", (F.floor(F.col("end") * bins / F.col("total")) - F.floor((F.col("end") - F.col("n")) * bins / F.col("total"))).alias("k")).where("k > 0")
    return [r["v"] for r in spans.orderBy("v").collect() for _ in range(r["k"])][: bins - 1]


class Curve:
    """The quantisation of some dimensions: bounds by rank, and the index on the curve of their bins."""

    def __init__(self, df: DataFrame, dims: list[str], bits: int = 6):
        """Each dimension gets at most 2**bits bins of near-equal counts, null in the first. Only bounds reach the driver."""
        self.dims, self.bits = dims, bits
        self.how = [dimension(df, d) for d in dims]
        rows = df.select(*(c.alias(f"d{i}__") for i, (c, _) in enumerate(self.how)))
        at = [k / (1 << bits) for k in range(1, 1 << bits)]
        numbers = [f"d{i}__" for i, (_, text) in enumerate(self.how) if not text]
        found = rows.agg(*(F.percentile_approx(c, at, 10_000).alias(c) for c in numbers)).first() if numbers else {}
        # Equal bounds stay: a frequent value takes as much of the axis as it has rows.
        self.bounds = [string_bounds(rows, f"d{i}__", 1 << bits) if text else np.array(found[f"d{i}__"] or [], "f8") for i, (_, text) in enumerate(self.how)]

    def columns(self) -> list[Column]:
        return [c.alias(f"d{i}__") for i, (c, _) in enumerate(self.how)]

    def add(self, rows: DataFrame, passed: list[str]) -> DataFrame:
        """The passed columns of rows that have columns() too, with `curve`."""
        how, bits, names = list(zip([text for _, text in self.how], self.bounds)), self.bits, [f"d{i}__" for i in range(len(self.how))]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                points = []
                for name, (text, bounds) in zip(names, how):
                    if text:
                        coded = batch.column(name).dictionary_encode()
                        bins = np.array([bisect_left(bounds, v) for v in coded.dictionary.to_pylist()] + [0], "i8")
                        points.append(bins[coded.indices.fill_null(len(bins) - 1).to_numpy(zero_copy_only=False)])
                    else:
                        v = batch.column(name).to_numpy(zero_copy_only=False).astype("f8")
                        points.append(np.where(np.isnan(v), 0, np.searchsorted(bounds, v, side="left")))
                index = hilbert_index(np.stack(points, axis=1).reshape(-1, len(names)), bits)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in passed), pa.array(index)], names=[*passed, "curve"])

        return map_arrow(rows, run, nullable(rows.select(*passed).schema).add("curve", "long"))


def _numbered(rows: DataFrame, passed: list[str], by: str | None = None) -> DataFrame:
    """Rows that are sorted within partitions, with their partition as `run` and their place in it, or in its part with one value of `by`, as `row`; and the sizes before each."""
    schema = nullable(rows.select(*passed).schema).add("run", "integer").add("row", "long").add("before", "long")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, held, last = 0, 0, None
        for batch in batches:
            n, size = batch.num_rows, batch.column("size").to_numpy()
            if not n:
                continue
            ends = held + np.cumsum(size)
            place = row + np.arange(n)
            if by:
                key = batch.column(by).to_numpy()
                new = np.flatnonzero(np.concatenate([[last is not None and key[0] != last], key[1:] != key[:-1]]))
                for a, b in zip(new, [*new[1:], n]):
                    place[a:b] = np.arange(b - a)
                last = key[-1]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in passed), batch.column("run"), pa.array(place), pa.array(ends - size)], names=[*passed, "run", "row", "before"])
            row, held = int(place[-1]) + 1, int(ends[-1])

    return map_arrow(rows.withColumn("run", F.spark_partition_id()), number, schema)


def _placed(rows: DataFrame, keys: list[str], passed: list[str], shards: int) -> DataFrame:
    """The passed columns with shard and slot: runs of near-equal total `size` in the order of keys."""
    runs = kept(_numbered(rows.repartitionByRange(*keys).sortWithinPartitions(*keys), passed), "runs")
    # One row for each run: as many as there are partitions.
    ahead = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sums = runs.groupBy("run").agg(F.count("*").alias("rows"), F.sum("size").alias("sizes"))
    sums = sums.select("run", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("rows"), F.coalesce(F.sum("sizes").over(ahead), F.lit(0)).alias("sizes"), F.sum("sizes").over(Window.orderBy("run").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"))
    found = runs.join(F.broadcast(sums), "run").withColumn("place", F.col("rows") + F.col("row"))
    at = F.floor((F.col("sizes") + F.col("before")) * shards / F.col("total"))
    found = found.withColumn("shard", F.when(F.col("total") > 0, F.least(F.lit(shards - 1), at)).otherwise(0).cast("int"))
    firsts = found.groupBy("shard").agg(F.min("place").alias("first"))  # one row for each shard
    return found.join(F.broadcast(firsts), "shard").select(*passed, "shard", (F.col("place") - F.col("first")).alias("slot"))


def assign_shards(df: DataFrame, dims: list[str], shards: int = SHARDS, size_col: str = "size", order: tuple[str, ...] = ("doc_id",), bits: int = 6) -> DataFrame:
    """df with curve, shard (0 to shards - 1) and slot (its place in the shard, gapless from 0).

    Rows are ordered by curve index, then by `order`; a shard is a run of that order of near-equal total size, off
    by less than one row. Sizes must not be negative or null. Nulls in dimensions go to the first bin. Repeated
    rows are ordered by where they lie. Columns named curve, shard or slot are replaced; all others pass through,
    whatever their names. An empty table gives an empty one. df should be small rows (ids and metadata): it is
    written to the shared folder.
    """
    curve, ties = Curve(df, dims, bits), [f"o{i}__" for i in range(len(order))]
    rows = df.select(F.struct("*").alias("r"), F.col(size_col).cast("long").alias("size"), *(F.col(c).alias(t) for c, t in zip(order, ties)), F.monotonically_increasing_id().alias("tie__"), *curve.columns())
    named = curve.add(rows, ["r", "size", *ties, "tie__"])
    out = _placed(named, ["curve", *ties, "tie__"], ["r", "size", "curve"], shards)
    return out.select(*(F.col("r")[c].alias(c) for c in df.columns if c.lower() not in ("curve", "shard", "slot")), "curve", "shard", "slot")


def shard_ranges(assigned: DataFrame, dims: list[str]) -> DataFrame:
    """The manifest for pruning: each shard's rows, bytes, and least and greatest value of each dimension."""
    return assigned.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"), *(f(d).alias(f"{n}_{d}") for d in dims for n, f in (("min", F.min), ("max", F.max))))


def write_shards(docs: DataFrame, dims: dict[str, Column], out: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", bits: int = 6) -> None:
    """Writes whole rows as Parquet in shard folders, sorted along the curve of `dims` (name to expression).

    A row's size is its text's UTF-8 bytes (null: none) plus 1; shards are runs of near-equal size. First ids,
    hashes and sizes alone give the keys at which the shards begin; then every row, repeated ones and those without
    an id too, goes once to its shard by its own keys. Equal rows around a shard's start are counted out. Files hold
    the columns of docs in a struct `r`, so no name clashes, with size, run and row beside it; their statistics on
    the dimensions, which stand beside it too, let a reader prune.
    """
    size = (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long")
    own = [F.col(id_col).alias("id__"), F.xxhash64(F.col(text_col)).alias("mark__"), size.alias("size"), *(c.alias(f"dim_{d}") for d, c in dims.items())]
    meta = kept(docs.select(*own), "metadata")
    curve, keys = Curve(meta, [f"dim_{d}" for d in dims], bits), ["curve", "id__", "mark__"]
    placed = _placed(curve.add(meta.select("*", *curve.columns()), ["id__", "mark__", "size"]), keys, [*keys, "size"], shards)
    placed = kept(placed, "placed")
    first = placed.groupBy("shard").agg(F.min(F.struct(*keys)).alias("first")).collect()  # one row for each shard
    starts = [(r["shard"], tuple(r["first"])) for r in sorted(first, key=lambda r: r["shard"]) if r["shard"]]
    rows = docs.select(F.struct("*").alias("r"), *own)
    passed = ["r", "id__", "mark__", "size", *(f"dim_{d}" for d in dims)]
    named = curve.add(rows.select("*", *curve.columns()), passed)
    kind = dict(meta.dtypes)["id__"]
    none = F.lit(0).cast(kind)
    order = lambda c, i, m: F.struct(c.cast("long").alias("a"), i.isNotNull().alias("b"), F.coalesce(i, none).alias("c"), m.cast("long").alias("d"))
    fixed = lambda k: (F.lit(k[0]), F.lit(k[1]).cast(kind), F.lit(k[2]))
    mine = order(F.col("curve"), F.col("id__"), F.col("mark__"))
    shard = F.greatest(F.lit(0), F.lit(0), *(F.when(mine >= order(*fixed(k)), s).otherwise(0) for s, k in starts))
    # Rows equal in all keys that lie on both sides of a shard's start, as only repeated rows can: each such key's rows are counted out.
    equal = {k: reduce(Column.__and__, (c.eqNullSafe(v) for c, v in zip((F.col("curve"), F.col("id__"), F.col("mark__")), fixed(k)))) for _, k in starts}
    which = F.coalesce(*(F.when(e, k) for k, e in enumerate(equal.values())), F.lit(-1)) if equal else F.lit(-1)
    shares: dict[int, list[tuple[int, int]]] = {}
    for r in placed.withColumn("key", which).where("key >= 0").groupBy("key", "shard").agg(F.count("*").alias("n")).orderBy("key", "shard").collect():  # fewer than two rows for each shard
        shares.setdefault(r["key"], []).append((r["shard"], r["n"]))
    split = {k: v for k, v in shares.items() if len(v) > 1}
    passed += ["curve", "shard"]
    named = named.withColumn("shard", shard)
    if split:
        repeated = which.isin(list(split))
        counted = kept(_numbered(named.where(repeated).withColumn("key", which).sortWithinPartitions("key"), [*passed, "key"], by="key"), "repeated")
        ahead = counted.groupBy("key", "run").agg(F.count("*").alias("n"))  # one row a key and partition
        ahead = ahead.select("key", "run", (F.sum("n").over(Window.partitionBy("key").orderBy("run")) - F.col("n")).alias("ahead"))
        at = F.col("ahead") + F.col("row")
        ends = [(k, s, sum(n for _, n in v[: i + 1])) for k, v in split.items() for i, (s, _) in enumerate(v)]
        dealt = F.coalesce(*(F.when((F.col("key") == k) & (at < end), s) for k, s, end in ends), F.col("shard"))
        named = named.where(~repeated).unionByName(counted.join(F.broadcast(ahead), ["key", "run"]).withColumn("shard", dealt.cast("int")).select(*passed))
    ties = [*keys, "tie__"]  # so that equal rows needn't all lie in one task
    dealt = named.withColumn("tie__", F.monotonically_increasing_id()).repartitionByRange("shard", *ties).sortWithinPartitions("shard", *ties)
    numbered = _numbered(dealt, ["r", "size", *(f"dim_{d}" for d in dims), "curve", "shard"], by="shard")
    numbered.drop("before").write.partitionBy("shard").option("compression", "zstd").parquet(out)
    dropped(meta)
    dropped(placed)


def read_shards(spark: SparkSession, out: str) -> DataFrame:
    """The rows of write_shards with shard and slot, which is gapless from 0 in each shard."""
    rows = spark.read.parquet(out)
    # One row for each file.
    files = rows.groupBy("shard", "run").agg(F.count("*").alias("n"))
    before = files.select("shard", "run", (F.sum("n").over(Window.partitionBy("shard").orderBy("run")) - F.col("n")).alias("before__"))
    return rows.join(F.broadcast(before), ["shard", "run"]).withColumn("slot", F.col("before__") + F.col("row")).drop("before__", "run", "row")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written to eight shards of near-equal bytes along the curve of language, source and size, and read back."""
    docs, out = table(spark, sf_dir, "documents"), new_path(spark, "shards")
    write_shards(docs, {"lang": F.col("lang"), "source": F.col("source"), "size": F.octet_length("text")}, out)
    rows = read_shards(spark, out)
    text = F.coalesce(F.col("r.text"), F.lit(""))
    size = F.when(F.col("r.text").isNull(), 0).otherwise(F.octet_length("r.text")) + 1
    return rows.select("r.doc_id", size.cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")

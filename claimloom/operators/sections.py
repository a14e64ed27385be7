"""Windows of sections, chunks of a bounded size, and the surroundings of terms, all as half-open code point offsets."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def windowed(paragraphs: DataFrame) -> DataFrame:
    """paragraphs with `window`, the number of their run of one section, from 1 in a slug.

    A section that is left and comes again is another window; the text before the first heading is one, too.
    """
    order = Window.partitionBy("deal_slug").orderBy("char_start")
    opens = F.coalesce((F.col("section") != F.lag("section").over(order)).cast("int"), F.lit(1))
    return paragraphs.withColumn("opens__", opens).withColumn("window", F.sum("opens__").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("int")).drop("opens__")


def section_windows(paragraphs: DataFrame) -> DataFrame:
    """(deal_slug, window, section, n_first, n_last, char_start, char_end) of each window."""
    runs = windowed(paragraphs.select("deal_slug", "n", "section", "char_start", "char_end"))
    return runs.groupBy("deal_slug", "window").agg(F.first("section").alias("section"), F.min("n").alias("n_first"), F.max("n").alias("n_last"), F.min("char_start").alias("char_start"), F.max("char_end").alias("char_end"))


def _folded(max_chars: int):
    """Rows (key, char_start, char_end) that arrive sorted, with the number of each row's chunk; what is open carries over from batch to batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, chunk, begin = None, 0, 0
        for batch in batches:
            out = []
            for k, start, end in zip(*(batch.column(c).to_pylist() for c in ("key", "char_start", "char_end"))):
                if k != key:
                    key, chunk, begin = k, 1, start
                elif end - begin > max_chars:
                    chunk, begin = chunk + 1, start
                out.append(chunk)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int32())], names=[*batch.schema.names, "chunk"])

    return run


def chunks(paragraphs: DataFrame, max_chars: int, keys: tuple[str, ...] = ("deal_slug",)) -> DataFrame:
    """(keys, chunk, n_first, n_last, char_start, char_end, over_long): paragraphs in order, as many to a chunk as `max_chars` allow.

    A chunk reaches from its first paragraph's start to its last one's end. Every paragraph is in exactly one; one
    that is longer than max_chars is a chunk of its own, which over_long says. Rows are folded in one pass over the sorted
    offsets of a key, of which only the open chunk is kept; no text is moved.
    """
    if max_chars < 1:
        raise ValueError("a chunk holds a character at least")
    rows = paragraphs.select(*keys, "n", "char_start", "char_end", F.to_json(F.struct(*keys)).alias("key")).repartition(*keys).sortWithinPartitions("key", "char_start", "n")
    placed = rows.mapInArrow(_folded(max_chars), T.StructType([*rows.schema, T.StructField("chunk", T.IntegerType())]))
    found = placed.groupBy(*keys, "chunk").agg(F.min("n").alias("n_first"), F.max("n").alias("n_last"), F.min("char_start").alias("char_start"), F.max("char_end").alias("char_end"))
    return found.withColumn("over_long", F.col("char_end") - F.col("char_start") > max_chars)


_UPPER, _LOWER = "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123)))


def term_hits(texts: DataFrame, terms: list[str], key: str = "deal_slug") -> DataFrame:
    """(key, term, at, size): every place of each term in a text, A-Z and a-z alike; of one term's places that overlap the first counts.

    A text is split at the term, and the lengths of the parts before give the place. Null texts and empty terms have none.
    """
    folded = F.translate("text", _UPPER, _LOWER)
    small = sorted({t.translate(str.maketrans(_UPPER, _LOWER)) for t in terms if t})
    parts = F.explode(F.array(*(F.struct(F.lit(t).alias("term"), F.lit(len(t)).alias("size"), F.split(folded, "\\Q" + t.replace("\\E", "\\E\\\\E\\Q") + "\\E", -1).alias("parts")) for t in small))).alias("x")
    rows = texts.where("text is not null").select(key, parts).where(F.size("x.parts") > 1).select(key, "x.term", "x.size", F.posexplode("x.parts").alias("pos", "part"))
    upto = Window.partitionBy(key, "term").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = F.sum(F.length("part") + F.col("size")).over(upto) - F.col("size")
    last = F.max("pos").over(Window.partitionBy(key, "term"))
    return rows.withColumn("at", at.cast("int")).withColumn("last", last).where("pos < last").select(key, "term", "at", "size")


def term_context(texts: DataFrame, terms: list[str], before: int, after: int, key: str = "deal_slug") -> DataFrame:
    """(key, char_start, char_end, hits, terms): stretches around terms, `before` and `after` characters about each place, cut at the text's ends.

    Stretches that overlap or touch are one: their starts and ends are put in order, and a stretch opens where no
    earlier one reaches. terms are those that begin in it, in order. A text without any has no row; texts of one key are an error.
    """
    sized = texts.where("text is not null").select(key, F.length("text").alias("length"))
    spans = term_hits(texts, terms, key).join(sized, key).select(key, "term", F.greatest(F.lit(0), F.col("at") - before).alias("char_start"), F.least(F.col("length"), F.col("at") + F.col("size") + after).alias("char_end"))
    order = Window.partitionBy(key).orderBy("char_start", "char_end", "term")
    reach = F.max("char_end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("opens", F.coalesce((F.col("char_start") > reach).cast("int"), F.lit(1))).withColumn("island", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return spans.groupBy(key, "island").agg(F.min("char_start").alias("char_start"), F.max("char_end").alias("char_end"), F.count("*").alias("hits"), F.array_join(F.array_sort(F.collect_set("term")), "|").alias("terms")).drop("island")

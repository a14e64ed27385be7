"""Identifiers: `{slug}_{kind}_{n}`, n from 1 within a slug."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def make_id(slug: Column, kind: str, n: Column) -> Column:
    return F.concat_ws("_", slug, F.lit(kind), n.cast("string"))


def numbered(df: DataFrame, kind: str, order: list, name: str, slug: str = "deal_slug") -> DataFrame:
    """df with an id column: a sequence within each slug in the given order."""
    n = F.row_number().over(Window.partitionBy(slug).orderBy(*order))
    return df.withColumn(name, make_id(F.col(slug), kind, n))


def suffix(ident: Column) -> Column:
    return F.regexp_extract(ident, "_([0-9]+)$", 1).try_cast("int")


def next_number(df: DataFrame, id_col: str, slug: str = "deal_slug") -> DataFrame:
    """Each slug's next free number."""
    return df.groupBy(slug).agg((F.coalesce(F.max(suffix(F.col(id_col))), F.lit(0)) + 1).alias("next_n"))


def placed(ranged: DataFrame, order: list, part: str = "part") -> DataFrame:
    """ranged with `place`, a sequence from 1 over all rows in the given order, without the column `part`.

    `ranged` is a stored table that was dealt into ranges of this order: `part` is a row's range, and no range begins before
    the one ahead of it ends. Rows are numbered within their ranges, and a range adds the sizes of those ahead; only
    these sizes, one a range, go through the driver.
    """
    sizes = sorted((r[part], r["n"]) for r in ranged.groupBy(part).agg(F.count("*").alias("n")).collect())
    ahead, rows = 0, []
    for k, n in sizes:
        rows.append((k, ahead))
        ahead += n
    offsets = ranged.sparkSession.createDataFrame(rows, f"{part} int, ahead__ long")
    within = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    return ranged.withColumn("place", within).join(F.broadcast(offsets), part).withColumn("place", F.col("place") + F.col("ahead__")).drop("ahead__", part)


def in_ranges(df: DataFrame, order: list, part: str = "part") -> DataFrame:
    """df dealt into ranges of an order, with each row's range; to be stored before placed() takes it."""
    return df.repartitionByRange(*order).withColumn(part, F.spark_partition_id())

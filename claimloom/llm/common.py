"""What the operators of this subpackage share: tables, shared storage, and Arrow passes over rows."""

from __future__ import annotations

import functools
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data, read by Spark alone so that any store will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="claimloom-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith(("local[", "local")) or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _local_folder()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: lineage is cut, and a lost executor costs no more than its tasks."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()  # lets Spark's cleaner drop the shuffle files that nothing reads any more
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Deletes a table that kept() gave and no later plan reads."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        place = jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(conf).delete(place, True)


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def map_arrow(df: DataFrame, function: Callable, schema: str | T.StructType) -> DataFrame:
    """df.mapInArrow in batches of at most 4 MB, so that long rows don't fill a worker; a limit that the session set itself stays."""
    if df.sparkSession.conf.get(BATCH) == "67108864b":
        df.sparkSession.conf.set(BATCH, "4m")
    return df.mapInArrow(function, schema)


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def add_columns(df: DataFrame, inputs: list[str], outputs: str, function: Callable[..., Iterator[list]], arrow_in: bool = False) -> DataFrame:
    """df with the columns of the DDL string `outputs`, made batch by batch in Arrow; no row moves.

    `function()` is called once in each task and returns a callable from lists of the inputs' values to lists of
    the outputs' values; with arrow_in it gets Arrow arrays. Columns of df that clash with an output's name are replaced.
    """
    new = T.StructType.fromDDL(outputs)
    names = {f.name.lower() for f in new}
    passed = [c for c in df.columns if c.lower() not in names]
    schema = T.StructType([*(df.schema[c] for c in passed), *new])

    arrow = to_arrow_schema(new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = function()
        for batch in batches:
            columns = made(*(batch.column(c) if arrow_in else batch.column(c).to_pylist() for c in inputs))
            arrays = [pa.array(v, f.type) for v, f in zip(columns, arrow)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in passed), *arrays], names=[*passed, *(f.name for f in arrow)])

    if len({c.lower() for c in df.columns}) < len(df.columns):
        raise ValueError("column names clash; give each column its own name first")
    return map_arrow(df, run, nullable(schema))


def set_aside(df: DataFrame, names: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """df with its columns of these names out of the way, and what gives exactly df's columns back of a table that has them all."""
    taken = {n.lower() for n in names}
    moved = [f"aside{i}__" if c.lower() in taken else c for i, c in enumerate(df.columns)]
    return df.toDF(*moved), lambda out: out.select(*(F.col(m).alias(c) for m, c in zip(moved, df.columns)))


def sifted(df: DataFrame, key: str, keys: DataFrame, bits: int = 1 << 26) -> DataFrame:
    """The rows of df whose `key` may stand in `keys`, a table with that column: all that do, and some others.

    A Bloom filter of one hash in `bits` bits, 8 MB at most whatever the size of `keys`, so it may be broadcast; an
    exact inner join is to follow, which then shuffles little of df (a semi-join would be moved ahead of the filter).
    The more keys there are, the less it holds back.
    """
    page = 1 << 15  # bits of one bitmap
    at = F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.lit(bits))
    maps = keys.select(at.alias("at__")).groupBy(F.floor(F.col("at__") / page).alias("page__")).agg(F.bitmap_construct_agg(F.col("at__") % page).alias("map__"))
    placed = df.withColumn("at__", at).withColumn("page__", F.floor(F.col("at__") / page))
    within = (F.col("at__") % page).cast("int")
    octet = F.conv(F.hex(F.substring(F.col("map__"), F.floor(within / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return placed.join(F.broadcast(maps), "page__").where(F.getbit(octet, within % 8) == 1).select(*df.columns)

"""Tables that cut lineage, in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="claimloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; in local mode without it a folder that goes with the process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _own_folder()


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet and read again: what follows costs a scan, and a lost executor its tasks only."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

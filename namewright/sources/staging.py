"""Small derived tables, written once to the shared checkpoint folder and read back."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="namewright-")


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; where unset, a temporary folder in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()


def run_folder(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application."""
    return f"{shared_folder(spark)}/namewright-{spark.sparkContext.applicationId}"


def clean_up(spark: SparkSession) -> None:
    """Delete what this application has staged; results that still read it must be written before."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return a scan of it.

    Meant for dictionaries and dimensions. The scan has a real file size, so Spark itself decides
    by its broadcast threshold between a broadcast and a shuffled join, and in the second case
    both inputs are plain exchanges that adaptive execution can split when a key is skewed. The
    files also cut the lineage and survive the loss of executors. ``clean_up`` deletes them.
    """
    path = f"{run_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

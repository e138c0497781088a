"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: list[str] = []


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="paperloom-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the session's checkpoint folder.

    Where none is configured, a local session gets a folder of this process; on a
    cluster, whose executors would not see that, it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: intermediate tables need a folder that all executors share")
        folder = _own_folder()
    _WRITTEN.append(f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex}")
    return _WRITTEN[-1]


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once and read back: several readers share its work, and a lost executor costs none."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Delete what this process has stored so far; frames that read it can't be used any more."""
    jvm = spark._jvm
    while _WRITTEN:
        at = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)

"""Tables that cut a long lineage, in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """This application's folder below the shared one that the cluster names in spark.checkpoint.dir.

    Where that is unset, a session in local mode gets a temporary folder; on a cluster that would be out of the executors' reach, so it is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-tamis-"))
        folder = context.getCheckpointDir()
    return f"{folder.rstrip('/')}/tamis/{context.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the tables that this application has written here; frames that still read them must be done with."""
    _delete(spark, scratch_folder(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df as a Parquet table in the shared folder and read that."""
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """Like written(), for as long as the block runs: frames that read the table must be done with by then."""
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _delete(spark, path)

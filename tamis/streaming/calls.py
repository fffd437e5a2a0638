"""Calls of a function of the user's over a growing queue: bounded concurrency, retries with growing waits, each row in one of two sinks.

The queue is a folder of JSON lines. A micro-batch calls the function for its new keys and writes all outcomes, done and failed, in one job under its
batch id, overwriting what an earlier try of that batch left; so after a restart each key stands once, in one sink. The function itself may be
called again for rows of a batch that was cut off.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tamis.streaming.ingest import exists

BUSY_BASE, UNUSABLE_BASE = 2.0, 1.5  # the n-th wait is the base to the power n


class Busy(Exception):
    """The other side can't answer now. after: seconds it asks to wait, at least."""

    def __init__(self, message: str = "busy", after: float = 0.0):
        super().__init__(message)
        self.after = after


class Unusable(Exception):
    """An answer came but can't be used; asking again may help."""


def called(df: DataFrame, function: Callable[[dict], dict], schema: str, attempts: int = 3, concurrency: int = 8, tasks: int | None = None, wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """df's columns, the columns of schema, attempts, error (null where the call went well). At most tasks * concurrency calls run at once.

    Busy and Unusable are tried again up to attempts times; any other exception fails its row at once.
    """
    made = StructType.fromDDL(schema)
    names = [f.name for f in made]
    full = StructType([*df.schema.fields, *made.fields, StructField("attempts", IntegerType()), StructField("error", StringType())])
    arrow, own = to_arrow_schema(full), to_arrow_schema(made)

    def one(row: dict) -> tuple:
        for n in range(1, attempts + 1):
            try:
                out = function(row)
                values = [pa.scalar(out.get(k), f.type).as_py() for k, f in zip(names, own, strict=True)]
                return (*row.values(), *values, n, None)
            except (Busy, Unusable) as e:
                why = f"{type(e).__name__}: {e}"
                if n < attempts:
                    wait(max(e.after, BUSY_BASE**n) if isinstance(e, Busy) else UNUSABLE_BASE**n)
            except Exception as e:  # not worth another try
                return (*row.values(), *[None] * len(names), n, f"{type(e).__name__}: {e}")
        return (*row.values(), *[None] * len(names), attempts, why)

    def run(batches):
        with ThreadPoolExecutor(concurrency) as pool:
            for b in batches:
                for low in range(0, b.num_rows, 64 * concurrency):
                    rows = list(pool.map(one, b.slice(low, 64 * concurrency).to_pylist()))
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    return (df.repartition(tasks) if tasks else df).mapInArrow(run, full)


def outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """All rows that batches have ended: outcome, batch and the columns of called()."""
    return spark.read.parquet(folder)


def done(spark: SparkSession, folder: str, key: str) -> DataFrame:
    return outcomes(spark, folder).where("outcome = 'done'").dropDuplicates([key])


def failed(spark: SparkSession, folder: str, key: str) -> DataFrame:
    """Keys that no batch has done, each with its last failure."""
    every = outcomes(spark, folder)
    bad = every.where("outcome = 'failed'").join(every.where("outcome = 'done'").select(key).distinct(), key, "left_anti")
    last = bad.groupBy(key).agg(F.max("batch").alias("batch"))
    return bad.join(last, [key, "batch"]).dropDuplicates([key])


def _write(rows: DataFrame, path: str) -> None:
    rows.withColumn("outcome", F.when(F.col("error").isNull(), "done").otherwise("failed")).write.mode("overwrite").partitionBy("outcome").parquet(path)


def follow(spark: SparkSession, queue: str, queue_schema: str, key: str, function: Callable[[dict], dict], schema: str, folder: str, checkpoint: str, files: int = 100, **how) -> StreamingQuery:
    """Calls the function for every new key of the queue's files, so many files a batch; ends when all is read. Rows without a key are left out. how: as for called."""

    def each(batch: DataFrame, number: int) -> None:
        path = f"{folder}/batch={number:09d}"
        fresh = batch.where(F.col(key).isNotNull()).dropDuplicates([key])
        if exists(spark, folder):
            others = spark.read.schema(StructType([*batch.schema.fields, StructField("batch", StringType())])).parquet(folder)
            fresh = fresh.join(others.where(F.col("batch") != f"{number:09d}").select(key).distinct(), key, "left_anti").select(*batch.columns)
        _write(called(fresh, function, schema, **how), path)

    stream = spark.readStream.schema(queue_schema).option("maxFilesPerTrigger", files).json(queue)
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def again(spark: SparkSession, queue_columns: list[str], key: str, function: Callable[[dict], dict], schema: str, folder: str, **how) -> None:
    """Calls the function once more for the keys that stand as failed, as a batch after all others."""
    rows = failed(spark, folder, key)
    last = outcomes(spark, folder).agg(F.max("batch")).first()[0]
    number = int(last) + 1 if last is not None else 0
    _write(called(rows.select(*queue_columns), function, schema, **how), f"{folder}/batch={(1 << 29) + number if number < 1 << 29 else number:09d}")

"""Resumable ingest: new JSON-line files are appended as they come, each row once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def keyed(df: DataFrame, key: str) -> DataFrame:
    """With __key: the key, or for rows without one a hash of the whole row, so that a replay finds those too."""
    whole = F.concat(F.lit("row:"), F.md5(F.to_json(F.struct(*df.columns))))
    return df.withColumn("__key", F.coalesce(F.concat(F.lit("key:"), F.col(key).cast("string")), whole))


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def follow(spark: SparkSession, path: str, schema: str, done: str, checkpoint: str, key: str = "id") -> StreamingQuery:
    """Appends rows of new files under path to the table at done, leaving out keys that stand there; ends when all is read."""

    def append(batch: DataFrame, _: int) -> None:
        fresh = keyed(batch, key).dropDuplicates(["__key"])
        if exists(spark, done):
            fresh = fresh.join(keyed(spark.read.schema(schema).parquet(done), key).select("__key"), "__key", "left_anti")
        fresh.drop("__key").write.mode("append").parquet(done)

    return spark.readStream.schema(schema).json(path).writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

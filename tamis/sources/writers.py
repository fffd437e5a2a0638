"""Record constructors and sinks: fixed record schema, rejects with reasons, language and category buckets, CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.functions.text import lang_bucket, null_empty
from tamis.operators.evalset import seq_ids
from tamis.sources import byte_ranges

KEYS = ("dataset", "category", "task_type", "lang", "split", "question", "answer", "solution", "source_file", "orig_id")


def record(**fields: Column) -> list[Column]:
    """The fixed fields of a record in order; what isn't given is empty. metadata is JSON text."""
    out = [null_empty(fields.get(k, F.lit(""))).alias(k) for k in KEYS]
    out.append(F.coalesce(fields.get("options", F.lit(None)), F.array()).cast("array<string>").alias("options"))
    out.append(F.coalesce(fields.get("metadata", F.lit(None)).cast("string"), F.lit("{}")).alias("metadata"))
    return out


def split_rejects(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with their reason): nothing is dropped silently."""
    d = df.withColumn("reject_reason", reason)
    return d.where("reject_reason is null").drop("reject_reason"), d.where("reject_reason is not null")


def write_normalized(df: DataFrame, path: str, order: list[str]) -> None:
    """JSON lines by dataset, with ids in write order within it."""
    seq_ids(df, "dataset", order).write.mode("overwrite").partitionBy("dataset").json(path)


def write_by_language(df: DataFrame, path: str, keep_unlabeled: bool = False) -> None:
    """JSON lines by language bucket and dataset; unlabelled rows only if asked for."""
    d = df.withColumn("bucket", lang_bucket(F.col("lang")))
    d = d if keep_unlabeled else d.where("bucket <> 'unlabeled'")
    d.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "dataset").json(path)


def write_by_category(records: DataFrame, path: str) -> None:
    """Session records (category, source, ...) as JSON lines by category and source; what a source had under a category goes first."""
    records.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("category", "source").json(path)


def merge_lines(spark: SparkSession, folder: str, path: str) -> None:
    """All JSON lines below a folder as one table of lines, in the order of their files' names."""
    spark.read.option("pathGlobFilter", "*.jsonl").option("recursiveFileLookup", True).text(folder).select("value", "_metadata.file_path", "_metadata.file_block_start").orderBy("file_path", "file_block_start").select("value").write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, mark: bool = False, columns: list[str] | None = None) -> None:
    """A folder of CSV files with a header; nested values as JSON text. mark: the first column's name starts with a byte order mark."""
    df = df.select(*columns) if columns else df
    nested = [c for c, t in df.dtypes if t.startswith(("array", "struct", "map"))]
    out = df.withColumns({c: F.to_json(c) for c in nested})
    out = out.withColumnRenamed(out.columns[0], "\ufeff" + out.columns[0]) if mark else out
    out.write.mode("overwrite").options(header=True, escape='"').csv(path)


def merge_each(spark: SparkSession, root: str, path: str) -> None:
    """The JSON lines of each folder below root as one folder of lines, by the folder's path there, in the order of their files' names."""
    byte_ranges.register(spark)
    d = spark.read.format("tamis_lines").load(root).where("file like '%.jsonl' and trim(value) <> ''")
    folder = F.regexp_replace(F.substring_index("file", root.rstrip("/") + "/", -1), r"/?[^/]+$", "")
    order = ["folder", "file", "offset"]
    d = d.select(folder.alias("folder"), "file", "offset", "value").repartitionByRange(*order).sortWithinPartitions(*order)
    d.select("folder", "value").write.mode("overwrite").partitionBy("folder").text(path)


def lines_to_csv(spark: SparkSession, lines: str, path: str, bad_rows: str = "drop") -> list[str]:
    """JSON lines as CSV: lines that are no objects go (or with bad_rows='fail' stop it, by file and line), the header is the union of all keys in the order of their first lines. Returns the header."""
    if bad_rows == "fail":
        byte_ranges.register(spark)
        read = spark.read.format("tamis_lines").options(json=True, errors="strict").load(lines)
    else:
        read = spark.read.text(lines)
    rows = read.select(F.try_parse_json("value").alias("row"), F.json_object_keys("value").alias("names"), F.monotonically_increasing_id().alias("at"))
    rows = rows.where(F.startswith(F.schema_of_variant("row"), F.lit("OBJECT"))).withColumn("m", F.col("row").cast("map<string,string>"))
    keys = rows.select("at", F.posexplode("names").alias("k", "key")).groupBy("key").agg(F.min(F.struct("at", "k")).alias("first"))
    header = [r["key"] for r in keys.orderBy("first").collect()]  # names of columns: as many as the CSV has
    rows.select(*[F.coalesce(F.try_element_at("m", F.lit(k)), F.lit("")).alias(k) for k in header] or [F.lit("").alias("empty")]).write.mode("overwrite").options(header=bool(header), escape='"').csv(path)
    return header

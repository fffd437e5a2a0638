"""Readers of raw corpora: JSON lines with a bad-row policy, numbered lines, JSON arrays, delimited files, XML, directories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tamis.sources import byte_ranges, json_index

RECORD = (
    "id string, dataset string, category string, task_type string, lang string, split string, question string, answer string, "
    "options array<string>, solution string, source_file string, orig_id string, metadata string"
)


def stem(path=None):
    return F.regexp_extract(F.col("_metadata.file_path") if path is None else path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def json_lines(spark: SparkSession, path: str, schema: str, bad_rows: str = "count") -> DataFrame:
    """Non-blank lines as records. bad_rows: 'count' keeps bad lines with their text in _bad, 'fail' stops at the first and names file and line."""
    if bad_rows == "fail":
        byte_ranges.register(spark)
        lines = spark.read.format("tamis_lines").options(json=True, errors="strict").load(path).where(F.trim("value") != "")
        return lines.select(F.from_json("value", schema).alias("r")).select("r.*")
    return spark.read.schema(f"{schema}, _bad string").option("columnNameOfCorruptRecord", "_bad").json(path)


def by_extension(spark: SparkSession, path: str, schema: str, bad_rows: str = "count") -> DataFrame:
    """Records of a file or folder whose format its name tells: .jsonl, .csv, .tsv or .parquet, with columns of schema; others are an error."""
    name = path.rstrip("/*").lower()
    if name.endswith((".jsonl", ".ndjson")):
        return json_lines(spark, path, schema, bad_rows)
    wanted = StructType.fromDDL(schema)
    if name.endswith(".parquet"):
        d = spark.read.parquet(path)
    elif name.endswith((".csv", ".tsv")):
        d = delimited(spark, path, "\t" if name.endswith(".tsv") else ",")
    else:
        raise ValueError(f"no format is known by the name of {path}: .jsonl, .csv, .tsv or .parquet")
    return d.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) if f.name in d.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted])


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines of each file with their numbers from 1: file, line, value. Large files are read by many tasks.

    A task reads the lines that begin in a byte range, so a line's number is its place there after the lines of earlier ranges.
    """
    byte_ranges.register(spark)
    lines = spark.read.format("tamis_lines").load(path)
    blocks = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # a row for each block
    return lines.join(blocks.withColumn("before", before), ["file", "block"]).select("file", (F.col("nth") + F.col("before") + 1).alias("line"), "value")


def count_lines(spark: SparkSession, path: str) -> int:
    """Physical lines of a file; 0 where there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return spark.read.text(path).count() if target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target) else 0


def raw_lines(spark: SparkSession, path: str, root: str = "") -> DataFrame:
    """JSON lines as raw rows: file (below root), at (line from 0), row (VARIANT; null where a line is no JSON). Blank lines go."""
    d = numbered_lines(spark, path).where(F.trim("value") != "")
    return d.select(below("file", root).alias("file"), (F.col("line") - 1).alias("at"), F.try_parse_json("value").alias("row"))


def below(column, root: str):
    c = F.col(column) if isinstance(column, str) else column
    return F.substring_index(c, root.rstrip("/") + "/", -1) if root else c


def raw_array(spark: SparkSession, path: str, root: str = "", keys: tuple[str, ...] = json_index.KEYS) -> DataFrame:
    """Elements of JSON arrays as raw rows: file, at, row, top (the outer object without the array, if there is one).

    The array is the file itself, the one under the first of keys that holds one, or the first list of the object. Files are read in blocks by many tasks.
    """
    d = json_index.elements(spark, path, keys)
    return d.select(below("file", root).alias("file"), F.try_parse_json("top").alias("top"), "at", F.try_parse_json("value").alias("row"))


def raw_table(df: DataFrame, file, root: str = "") -> DataFrame:
    """Rows of a CSV or Parquet table as raw rows; file is the column of the path."""
    return df.select(below(file, root).alias("file"), F.lit(None).cast("long").alias("at"), F.to_variant_object(F.struct(*[c for c in df.columns if c != file])).alias("row"))


def arrow_stream(spark: SparkSession, path: str) -> DataFrame:
    """Rows of Arrow streams: file, at, row. Tasks read runs of record batches."""
    byte_ranges.register(spark)
    return spark.read.format("tamis_arrow").load(path).select("file", "at", F.try_parse_json("json").alias("row"))


def zipped_csv(spark: SparkSession, path: str, start: str = "", suffix: str = ".csv") -> DataFrame:
    """Rows of the CSV members of ZIP files whose names begin and end so: file (archive!member), at, row. A task streams a member."""
    byte_ranges.register(spark)
    return spark.read.format("tamis_zip").options(begin=start, end=suffix).load(path).select("file", "at", F.try_parse_json("json").alias("row"))


def task_directories(spark: SparkSession, path: str, depth: int = 1, exclude: str | None = None) -> DataFrame:
    """One raw row a directory ``depth`` levels below path: file (the directory), row (texts of the files in it by their paths)."""
    d = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("p"), "value")
    d = d.where(~F.contains("p", F.lit(exclude))) if exclude else d
    parts = F.split(F.substring_index("p", path.rstrip("/") + "/", -1), "/")
    d = d.select(F.array_join(F.slice(parts, 1, depth), "/").alias("file"), F.array_join(F.slice(parts, depth + 1, 100), "/").alias("name"), "value").where("name <> ''")
    return d.groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("m")).select("file", F.try_parse_json(F.to_json("m")).alias("row"))


def json_array(spark: SparkSession, path: str, schema: str, keys: tuple[str, ...] = json_index.KEYS) -> DataFrame:
    """Elements of a JSON array, or of the array under the first of keys that holds one, as records."""
    return json_index.elements(spark, path, keys).select(F.from_json("value", schema).alias("r")).select("r.*")


def delimited(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """CSV or TSV with a header: quoted fields may hold newlines; a byte order mark is dropped, all columns are text."""
    d = spark.read.options(header=True, multiLine=True, escape='"', sep=sep, maxCharsPerColumn=-1, inferSchema=False).csv(path)
    return d.withColumnsRenamed({c: c.lstrip("﻿") for c in d.columns if c.startswith("﻿")})


def xml_rows(spark: SparkSession, path: str, tag: str) -> DataFrame:
    return spark.read.option("rowTag", tag).xml(path)


def directories(spark: SparkSession, path: str) -> DataFrame:
    """One row a file below path: the directory it stands in, its name, its text."""
    d = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    file = F.col("_metadata.file_path")
    return d.select(F.regexp_extract(file, r"([^/]+)/[^/]+$", 1).alias("dir"), F.regexp_extract(file, r"([^/]+)$", 1).alias("name"), "value")


def normalized(spark: SparkSession, path: str) -> DataFrame:
    """A normalised corpus: a directory or file of JSON lines; dataset falls back to the file's name."""
    d = spark.read.schema(RECORD).json(path)
    return d.withColumn("dataset", F.coalesce(F.nullif("dataset", F.lit("")), stem()))

"""One run over a folder of collections: each sub-folder is read in the form its collection has, normalised, and united with the others."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamis.functions.text import null_empty
from tamis.operators import normalizers
from tamis.sources import readers

# The form in which each dataset comes.
FORMS = {
    "parquet": ("gsm8k", "PolyMath", "aqua_rat", "ChilleD_SVAMP", "math", "ceval-data", "swe-bench-data", "LawBench", "aime-2025", "aime-2026", "chembench", "scivqr", "ruler", "prbench", "criticleanbench"),
    "lines": ("apple_gsm_symbolic", "gsm_plus", "mathmist", "longbench-data", "AlignBench", "ChineseSimpleQA", "livecodebench-data", "ifeval-data", "physics-data", "bfcl", "scicode", "financebench"),
    "array": ("MultiArith", "mmath", "mathqa", "GAOKAO-Bench", "SafetyBench", "HalluQA", "CUAD", "apex-agents", "formalmath", "hipho", "sciarena-literature"),
    "csv": ("CMMLU", "apex-v1-extended", "arena-human-preference-55k"), "tsv": ("legalbench",), "xml": ("asdiv",), "arrow": ("gsm1k",), "zip": ("fineval",),
    "tasks": ("apex-accounting", "terminal-bench", "aider-polyglot"),
}
FORM_OF = {name: form for form, names in FORMS.items() for name in names}
SIDES = {"SafetyBench": "answers", "legalbench": "tasks", "apex-agents": "worlds"}
DEPTH = {"aider-polyglot": 4}
XML_TAG, ZIP_FOLDER = "Problem", "dev/"
SAMPLE_CHARS = 120


def discovered(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders in root, but for hidden ones: as many as there are collections."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(s.getPath().getName() for s in found if s.isDirectory() and not s.getPath().getName().startswith((".", "_")))


def raw(spark: SparkSession, root: str, folder: str, name: str) -> DataFrame:
    """Raw rows of a dataset in the folder root/folder."""
    path, form = f"{root.rstrip('/')}/{folder}", FORM_OF[name]
    with_file = lambda d: readers.raw_table(d.select("*", F.col("_metadata.file_path").alias("__file")), "__file", root)
    if form == "parquet":
        return with_file(spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(path))
    if form in ("csv", "tsv"):
        d = spark.read.options(header=True, multiLine=True, escape='"', sep="," if form == "csv" else "\t", maxCharsPerColumn=-1, inferSchema=False, recursiveFileLookup=True).csv(path)
        return with_file(d.withColumnsRenamed({c: c.lstrip("﻿") for c in d.columns if c.startswith("﻿")}))
    if form == "lines":
        return readers.raw_lines(spark, path, root)
    if form == "array":
        return readers.raw_array(spark, path, root)
    if form == "xml":
        return with_file(spark.read.option("rowTag", XML_TAG).option("recursiveFileLookup", True).xml(path))
    if form == "arrow":
        return readers.arrow_stream(spark, path).withColumn("file", readers.below("file", root))
    if form == "zip":
        return readers.zipped_csv(spark, path, ZIP_FOLDER).withColumn("file", readers.below("file", root))
    return readers.task_directories(spark, path, DEPTH.get(name, 1))


def build(spark: SparkSession, root: str, sides: dict[str, DataFrame] | None = None, only: list[str] | None = None) -> tuple[DataFrame | None, list[str]]:
    """(records of all collections below root with reject_reason, names of folders that none has).

    sides: by dataset the table that it joins (``SIDES`` names it); a dataset that lacks its own is an error. only: names to take, in any spelling.
    """
    frames, unknown = [], []
    wanted = None if only is None else {normalizers.find(n).name for n in only}
    for folder in discovered(spark, root):
        try:
            name = normalizers.find(folder).name
        except KeyError:
            unknown.append(folder)
            continue
        if wanted is not None and name not in wanted:
            continue
        side = {SIDES[name]: (sides or {})[name]} if name in SIDES else {}
        frames.append(normalizers.normalize(raw(spark, root, folder, name), name, **side))
    return (reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else None), unknown


def report(records: DataFrame) -> DataFrame:
    """dataset, reason, n: rows (reason ''), rejects by reason, and under the dataset '' the sums over all: one aggregate."""
    d = records.select("dataset", F.coalesce("reject_reason", F.lit("")).alias("reason"))
    return d.groupingSets([["dataset", "reason"], ["reason"]], "dataset", "reason").agg(F.count(F.lit(1)).alias("n")).withColumn("dataset", null_empty(F.col("dataset")))


def samples(records: DataFrame, order: list[str], most: int = 3) -> DataFrame:
    """dataset, empty_answers, samples: how many good rows have no answer, and the first rows with questions and answers cut short."""
    good = records.where("reject_reason is null")
    first = good.withColumn("i", F.row_number().over(W.partitionBy("dataset").orderBy(*order))).where(F.col("i") <= most)
    cut = lambda c: F.substring(null_empty(F.col(c)), 1, SAMPLE_CHARS).alias(c)
    shown = first.groupBy("dataset").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", F.struct(cut("question"), cut("answer"), "options", "task_type", "lang", "split").alias("row")))), lambda x: x["row"]).alias("samples"))
    counts = good.groupBy("dataset").agg(F.count_if(null_empty(F.col("answer")) == "").alias("empty_answers"))
    return counts.join(shown, "dataset")

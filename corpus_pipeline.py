"""A corpus pipeline: toxicity, near duplicates, decontamination, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. The first four return
the columns of documents; the last writes token shards and returns what it reads back from them.

Every stage takes rows with nulls in any column, blank and very long texts, ties, repeated rows, tables without rows, and
further columns of any name, which go through the first four. A null or blank text is scored like any other by toxicity, is a
copy of nothing, holds no test item, has size 0 in the mix (so none, one or two copies of no words), and becomes the end id alone.
Repeated rows are near copies of each other: one stays. Null ids come last where an id decides, null sources are one source.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tamis.llm.common import scratch_folder, table
from tamis.llm.decontaminate import without_contaminated
from tamis.llm.mixing import repeated
from tamis.llm.near_duplicates import one_of_each
from tamis.llm.token_ids import encoded
from tamis.llm.toxicity import without_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the model is learned from the labelled ones among docs."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item, exact or edited, go."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: some not at all, some twice."""
    return repeated(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row in shard files, read back: doc_id, start, n_tokens, ids_crc32."""
    return encoded(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_ids", write_token_ids),
]

# The learned and aligned stages have no SQL form; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{scratch_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs

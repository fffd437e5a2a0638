"""Frozen tables: a manifest with a hash tree over partitions, its check, and isolation from training rows.

A row's hash is SHA-256 of its columns in a canonical text. A leaf is a partition's rows whose key falls in one of 256 buckets; its hash is of
their number and of the sums of the row hashes' pieces, so rows need no order and any number of them no more than partial sums. A partition's hash is over its
leaves, the root's over all partitions' hashes, by sums again. A changed, lost or added row changes one leaf, which names partition and bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.functions.text import norm_question

PIECES = ((1, 13), (14, 13), (27, 13), (40, 13), (53, 12))  # hex digits of a hash, in numbers below 2^52


def canonical(columns: list[str]) -> Column:
    """Columns as one text that tells null from empty and where each ends: their lengths and texts, null as '-'."""
    one = lambda c: F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
    return F.concat_ws(",", *[one(c) for c in columns])


def summed(hashed: Column) -> list[Column]:
    return [F.sum(F.conv(F.substring(hashed, at, n), 16, 10).cast("decimal(20,0)")).alias(f"s{at}") for at, n in PIECES]


def digest(n: str = "n") -> Column:
    return F.sha2(F.concat_ws(":", F.col(n).cast("string"), *[F.col(f"s{at}").cast("string") for at, _ in PIECES]), 256)


def leaves(df: DataFrame, key: str, part: str) -> DataFrame:
    """part, bucket, n, hash: null parts are ''."""
    columns = sorted(df.columns)
    rows = df.select(F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.substring(F.sha2(F.coalesce(F.col(key).cast("string"), F.lit("")), 256), 1, 2).alias("bucket"), F.sha2(canonical(columns), 256).alias("h"))
    return rows.groupBy("part", "bucket").agg(F.count(F.lit(1)).alias("n"), *summed(F.col("h"))).select("part", "bucket", "n", digest().alias("hash"))


def manifest(df: DataFrame, key: str, part: str) -> DataFrame:
    """level (leaf, partition, root), part, bucket, n, hash. Equal for equal rows in any order; columns count by name, not by place. An empty table has a root alone."""
    low = leaves(df, key, part)
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "hash"))), lambda x: F.concat(x["bucket"], F.lit(":"), x["hash"])), ",")  # 256 at most
    middle = low.groupBy("part").agg(F.sum("n").alias("n"), F.sha2(listed, 256).alias("hash"))
    top = middle.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *summed(F.sha2(F.concat_ws(":", "part", "hash"), 256)))
    return (
        low.select(F.lit("leaf").alias("level"), "part", "bucket", "n", "hash")
        .unionByName(middle.select(F.lit("partition").alias("level"), "part", F.lit("").alias("bucket"), "n", "hash"))
        .unionByName(top.select(F.lit("root").alias("level"), F.lit("").alias("part"), F.lit("").alias("bucket"), "n", digest().alias("hash")))
    )


def verified(df: DataFrame, kept: DataFrame, key: str, part: str) -> DataFrame:
    """part, bucket, change, was, now: leaves of a table that aren't those of its manifest. change: lost, added or changed (as many rows, others). No rows: the table is as it was."""
    old, new = kept.where("level = 'leaf'").alias("old"), leaves(df, key, part).alias("new")
    both = old.join(new, (F.col("old.part") == F.col("new.part")) & (F.col("old.bucket") == F.col("new.bucket")), "full_outer")
    was, now = F.coalesce("old.n", F.lit(0)), F.coalesce("new.n", F.lit(0))
    change = F.when(was > now, "lost").when(was < now, "added").otherwise("changed")
    return both.where(~F.col("old.hash").eqNullSafe(F.col("new.hash"))).select(F.coalesce("old.part", "new.part").alias("part"), F.coalesce("old.bucket", "new.bucket").alias("bucket"), change.alias("change"), was.alias("was"), now.alias("now"))


def isolated(items: DataFrame, train: DataFrame, text: str = "text") -> DataFrame:
    """Items whose text, case and blanks aside, no training row has."""
    key = lambda d: F.md5(norm_question(F.col(text)))
    seen = train.select(key(train).alias("k")).distinct()
    rows = items.select(F.struct("*").alias("row"), key(items).alias("k"))
    return rows.join(seen, "k", "left_anti").select("row.*")

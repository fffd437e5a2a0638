"""Counts behind corpus reports: value counts, histograms with empty bins kept, cross tables, links, matrices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Edges and names of the bins.
LENGTH_BINS = ((100, "<=100"), (300, "101-300"), (800, "301-800"), (2000, "801-2K"), (5000, "2K-5K"), (None, ">5K"))
CHAR_BINS = ((1 << 10, "<1K"), (1 << 12, "1K-4K"), (1 << 14, "4K-16K"), (1 << 16, "16K-64K"), (1 << 18, "64K-256K"), (None, ">256K"))
TURN_BINS = ((1, "1"), (2, "2"), (4, "3-4"), (8, "5-8"), (16, "9-16"), (None, ">16"))
MESSAGE_BINS = ((1, "1"), (2, "2"), (3, "3"), (6, "4-6"), (12, "7-12"), (24, "13-24"), (None, ">24"))


def value_counts(df: DataFrame, field: str, drop_empty: bool = False) -> DataFrame:
    v = F.coalesce(F.col(field).cast("string"), F.lit(""))
    d = df.groupBy(v.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return d.where("value <> ''") if drop_empty else d


def histogram(df: DataFrame, value: Column, bins, below: bool = False) -> DataFrame:
    """Rows of each bin: value <= upper (or < upper with below); bins without rows have n = 0."""
    name = F.lit(bins[-1][1])
    for upper, label in reversed(bins[:-1]):
        name = F.when(value < upper if below else value <= upper, label).otherwise(name)
    counts = df.groupBy(name.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    names = df.sparkSession.createDataFrame([(i, b[1]) for i, b in enumerate(bins)], "ord int, bin string")
    return names.join(counts, "bin", "left").select("ord", "bin", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def cross(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def links(df: DataFrame, *levels: str) -> DataFrame:
    """Links between neighbouring levels: source, target, value; null counts as unknown."""
    named = df.select(*[F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit("unknown")).alias(c) for c in levels])
    pairs = F.array(*[F.struct(F.lit(i).alias("level"), F.col(a).alias("source"), F.col(b).alias("target")) for i, (a, b) in enumerate(zip(levels, levels[1:], strict=False))])
    return named.select(F.explode(pairs).alias("p")).groupBy("p.level", "p.source", "p.target").agg(F.count(F.lit(1)).alias("value"))


def totals(df: DataFrame, dims: list[str], sets: list[list[str]], chars: str, distinct: str | None = None) -> DataFrame:
    """Counts at several levels in one aggregate: dims, level, n, chars, mean_chars, share, and distinct values of a column.

    sets: the levels, each the dims it keeps; level is the grouping id (a bit for each dim that is summed over, the last dim lowest), dims summed over are
    null, a null value of a dim is ''. share: per cent of all rows, to one digit, if sets holds the level of all. mean_chars is 0 without rows.
    """
    d = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in dims], F.length(F.coalesce(chars, F.lit(""))).alias("__c"), F.col(distinct or dims[0]).alias("__d"))
    counts = [F.count(F.lit(1)).alias("n"), F.sum("__c").alias("chars"), *([F.countDistinct("__d").alias(f"{distinct}s")] if distinct else [])]
    out = d.groupingSets(sets, *dims).agg(F.grouping_id().alias("level"), *counts)
    everything = F.max(F.when(F.col("level") == (1 << len(dims)) - 1, F.col("n"))).over(W.partitionBy())  # a row a group
    out = out.withColumn("__all", everything)
    tenths = lambda a, b: F.expr(f"((20 * {a} + {b}) div (2 * {b})) / 10.0D")  # noqa: E731  # of whole numbers, halves up, exactly
    return out.withColumns({"mean_chars": F.when(F.col("n") > 0, tenths("chars", "n")).otherwise(0.0), "share": tenths("(100 * n)", "__all")}).drop("__all")


def matrix(df: DataFrame, row: str, column: str, columns: list[str]) -> DataFrame:
    """Counts of row x column with zeros and a total."""
    d = df.groupBy(row).agg(*[F.count_if(F.col(column) == c).alias(c) for c in columns], F.count(F.lit(1)).alias("total"))
    return d

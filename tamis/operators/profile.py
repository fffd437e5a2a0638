"""What a table holds, column by column, in one pass, as states that can be merged: exact counts, and sketches for what can't be exact.

``states`` gives a row a column; ``merged`` joins the states of many loads without their rows; ``read`` turns them into estimates:
distinct values (HyperLogLog, 2^12 registers: 1.6 % standard error), quantiles of numbers (KLL, rank error about 1.3 %), the most
frequent values (counters for ``TRACKED`` values), and the schema of JSON texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRACKED = 1_000
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def states(df: DataFrame) -> DataFrame:
    """column, kind, n, nulls, chars, least_text, most_text, least, most, distinct, quantiles, top, shape: a row a column, whatever their types."""
    cells: list[Column] = []
    out: list[Column] = [F.count(F.lit(1)).alias("n")]
    for i, (name, kind) in enumerate(df.dtypes):
        c = F.col(f"`{name}`")
        plain = not kind.startswith(("array", "map", "struct", "variant"))
        text = c.cast("string") if plain else F.to_json(F.struct(c))
        number = c.cast("double") if kind.startswith(NUMBERS) else F.lit(None).cast("double")
        string = c if kind == "string" else F.lit(None).cast("string")
        out += [
            F.count_if(c.isNull()).alias(f"nulls{i}"), F.coalesce(F.sum(F.length(text)), F.lit(0)).cast("long").alias(f"chars{i}"), F.min(string).alias(f"lt{i}"), F.max(string).alias(f"mt{i}"),
            F.min(number).alias(f"l{i}"), F.max(number).alias(f"m{i}"), F.hll_sketch_agg(text).alias(f"d{i}"), F.kll_sketch_agg_double(number).alias(f"q{i}"),
            F.call_function("approx_top_k_accumulate", text, F.lit(TRACKED)).alias(f"t{i}"), F.schema_of_variant_agg(F.try_parse_json(string)).alias(f"s{i}"),
        ]
        names = (("nulls", "nulls"), ("chars", "chars"), ("lt", "least_text"), ("mt", "most_text"), ("l", "least"), ("m", "most"), ("d", "distinct"), ("q", "quantiles"), ("t", "top"), ("s", "shape"))
        cells.append(F.struct(F.lit(name).alias("column"), F.lit(kind).alias("kind"), "n", *[F.col(f"{a}{i}").alias(b) for a, b in names]))
    return df.agg(*out).select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def merged(loads: DataFrame) -> DataFrame:
    """States of several loads as those of all their rows; the shape of JSON is that of the load which has most rows."""
    return loads.groupBy("column", "kind").agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.sum("chars").alias("chars"), F.min("least_text").alias("least_text"), F.max("most_text").alias("most_text"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("quantiles").alias("quantiles"), F.call_function("approx_top_k_combine", F.col("top"), F.lit(TRACKED)).alias("top"), F.max_by("shape", "n").alias("shape"))


def read(kept: DataFrame, most: int = 5) -> DataFrame:
    """Exact counts, and estimates of distinct values, quartiles and the most frequent values."""
    filled = F.col("least").isNotNull()
    quartiles = F.when(filled, F.kll_sketch_get_quantile_double("quantiles", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))))
    return kept.select(
        "column", "kind", "n", "nulls", "chars", "least_text", "most_text", "least", "most", F.hll_sketch_estimate("distinct").alias("distinct"), quartiles.alias("quartiles"),
        F.call_function("approx_top_k_estimate", F.col("top"), F.lit(most)).alias("frequent"), "shape")

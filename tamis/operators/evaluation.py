"""Wide evaluation tables: cells of rows and candidates, column families and their order, retries, scores, pass rates."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def candidates(df: DataFrame, ids: list[str], pattern: str) -> DataFrame:
    """Columns whose name matches pattern (its group is the candidate's name) as rows: ids, candidate, value."""
    found = {c: m[1] for c in df.columns if (m := re.fullmatch(pattern, c))}
    long = df.unpivot(ids, list(found), "candidate", "value")
    name = F.element_at(F.create_map(*[F.lit(x) for kv in found.items() for x in kv]), F.col("candidate"))
    return long.withColumn("candidate", name)


def weighted(scores: dict[str, Column], weights: dict[str, float]) -> Column:
    total = sum(weights.values())
    return sum((c * F.lit(weights[k] / total) for k, c in scores.items()), F.lit(0.0))


def pass_rates(long: DataFrame, candidate: str, score: str, threshold: float) -> DataFrame:
    return long.groupBy(candidate).agg(
        F.count(score).alias("scored"), F.count_if(F.col(score).isNull()).alias("failed"), F.avg(score).alias("avg_score"),
        F.avg(F.when(F.col(score).isNotNull(), (F.col(score) >= threshold).cast("double"))).alias("pass_rate"),
    )


# The column families of a candidate and of a judge, in order, by what is recorded; and where a question may stand.
FAMILIES = {
    "answer": ("answer",), "reasoning": ("reasoning",), "tool_calls": ("tool_calls",), "finish_reason": ("finish_reason",), "latency": ("latency_ms",),
    "usage": ("prompt_tokens", "cached_tokens", "completion_tokens", "reasoning_tokens", "total_tokens"), "throughput": ("throughput_tps",), "retries": ("retries",),
}
JUDGED = ("score", "pass", "comment", "dims", "referee_prompt_tokens", "referee_completion_tokens", "referee_total_tokens", "referee_error")
QUESTIONS = ("question", "prompt", "instruction", "query", "input", "text")


def slug(name: str) -> str:
    return re.sub("[^A-Za-z0-9]+", "_", name).strip("_")


def question_column(columns: list[str]) -> str | None:
    """The first of the columns that questions may stand in."""
    return next((c for c in QUESTIONS if c in columns), None)


def family(candidate: str, record: tuple[str, ...] = ("answer", "usage")) -> list[str]:
    """A candidate's columns: what is recorded, in fixed order, and always its error."""
    return [f"{c}_{slug(candidate)}" for kind, columns in FAMILIES.items() if kind in record for c in columns] + [f"error_{slug(candidate)}"]


def judged(referee: str, candidate: str) -> list[str]:
    return [f"{c}_{slug(referee)}_{slug(candidate)}" for c in JUDGED]


def cells(rows: DataFrame, names: list[str], column: str = "candidate") -> DataFrame:
    """Each row once for each of a few names."""
    return rows.withColumn(column, F.explode(F.array(*map(F.lit, names))))


def widened(rows: DataFrame, long: DataFrame, ids: list[str], names: list[str], record: tuple[str, ...] = ("answer", "usage"), referees: tuple[str, ...] = ()) -> DataFrame:
    """rows with the columns of each candidate (then of each judge of it) from long rows (ids, candidate, referee, fields): one aggregation.

    A column of a candidate stands there whether it has values or not; missing values are null.
    """
    fields = [c for c in long.columns if c not in (*ids, "candidate", "referee")]

    def cell(field: str, full: str, name: str, referee: str | None = None) -> Column:
        if field not in fields:
            return F.lit(None).cast("string").alias(full)
        own = F.filter("cells", lambda x: (x["candidate"] == name) & F.equal_null(x["referee"], F.lit(referee).cast("string")))
        return F.array_max(F.transform(own, lambda x: x[field])).alias(full)

    picks = []
    for name in names:
        for full in family(name, record):
            picks.append(cell(full.removesuffix(f"_{slug(name)}"), full, name))
    for name in names:
        for referee in referees:
            for full in judged(referee, name):
                picks.append(cell(full.removesuffix(f"_{slug(referee)}_{slug(name)}"), full, name, referee))
    # A list of a row's few cells: no sort of the long rows, as maxima of texts would need.
    wide = long.groupBy(*ids).agg(F.collect_list(F.struct("candidate", "referee", *fields)).alias("cells")).select(*ids, *picks)
    return rows.join(wide, ids, "left").select(*rows.columns, *[c for c in wide.columns if c not in ids])


def failed(df: DataFrame) -> Column:
    """Whether a wide row has a failed cell."""
    errors = [F.coalesce(F.col(c).cast("string"), F.lit("")) != "" for c in df.columns if c.startswith("error_")]
    return reduce(or_, errors, F.lit(False))


def retried(done: DataFrame, again: DataFrame, ids: list[str], candidate: str, record: tuple[str, ...] = ("answer", "usage")) -> DataFrame:
    """done with a candidate's whole family from again where its cell had failed and again has no error; other rows stay as they are."""
    own, error = family(candidate, record), f"error_{slug(candidate)}"
    fresh = again.where(F.coalesce(F.col(error), F.lit("")) == "").select(*ids, *[F.col(c).alias(f"__{c}") for c in own], F.lit(True).alias("__new"))
    joined = done.join(fresh, ids, "left")
    take = F.coalesce("__new", F.lit(False)) & (F.coalesce(F.col(error), F.lit("")) != "")
    return joined.select(*[F.when(take, F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in own else F.col(c) for c in done.columns])


def to_judge(answer: Column, tool_calls: Column, error: Column) -> Column:
    """Whether a cell has something to judge: no error, and an answer or tool calls."""
    present = lambda c: F.coalesce(c.cast("string"), F.lit("")) != ""
    return ~present(error) & (present(answer) | present(tool_calls))


def run_stats(long: DataFrame) -> DataFrame:
    """long: candidate, error, latency_ms, prompt_tokens, completion_tokens. Cells, failures, mean latency of good cells, token sums, by candidate."""
    good = F.coalesce(F.col("error"), F.lit("")) == ""
    return long.groupBy("candidate").agg(
        F.count_if(good).alias("ok"), F.count_if(~good).alias("failed"), F.avg(F.when(good, F.col("latency_ms"))).alias("avg_latency_ms"),
        F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("completion_tokens").alias("completion_tokens"),
    )


def check_judge(low: float, high: float, threshold: float, dimensions: list[str], weights: dict[str, float], samples: int, output: str) -> list[str]:
    """What is wrong with a judge's settings; nothing if they can be used."""
    return [why for why, wrong in (
        ("min must be below max", low >= high), ("pass_threshold must lie between them", not low <= threshold <= high), ("weights must be those of the dimensions", set(weights) != set(dimensions)),
        ("samples must be at least 1", samples < 1), ("output must hold {{referee}}", "{{referee}}" not in output),
    ) if wrong]

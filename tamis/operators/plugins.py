"""Functions of the user's over rows: a declared schema of what comes out, errors caught row by row.

A processing function takes a row as a dict and returns a dict, a list of dicts, or None for no row. A judge takes a row and returns its score, or a dict of
score, pass, comment and dimensions. Functions go to the workers with the job, so they need no files there.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType


def processed(df: DataFrame, function: Callable[[dict], dict | list[dict] | None], schema: str, keep: list[str] | None = None) -> DataFrame:
    """keep (all columns, if not given), the columns of schema, and error: null, or what the function or the schema had against this row.

    A row that fails comes once, with nulls for the schema's columns. Fields that the schema has not are an error; those that are missing are null.
    """
    keep = df.columns if keep is None else keep
    made = StructType.fromDDL(schema)
    full = StructType([*[df.schema[c] for c in keep], *made.fields, StructField("error", StringType())])
    arrow, own = to_arrow_schema(full), to_arrow_schema(made)
    names = [f.name for f in made]

    def one(row: dict) -> list[tuple]:
        head = tuple(row[c] for c in keep)
        try:
            out = function(row)
            out = [] if out is None else [out] if isinstance(out, dict) else list(out)
            for o in out:
                if beyond := set(o) - set(names):
                    raise ValueError(f"fields that aren't declared: {', '.join(sorted(beyond))}")
            values = [tuple(o.get(n) for n in names) for o in out]
            for v in values:
                for x, f in zip(v, own, strict=True):
                    pa.scalar(x, f.type)
            return [(*head, *v, None) for v in values]
        except Exception as e:  # the row's own failure
            return [(*head, *[None] * len(names), f"{type(e).__name__}: {e}")]

    def run(batches):
        for b in batches:
            rows = [r for row in b.to_pylist() for r in one(row)]
            columns = list(zip(*rows, strict=True)) or [()] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, full)


@dataclass(frozen=True)
class Judge:
    """least and most a score may be, the score from which a row passes, and weights of dimensions (then the score is their weighted sum)."""

    function: Callable[[dict], float | dict]
    least: float = 0.0
    most: float = 1.0
    threshold: float = 0.5
    weights: tuple[tuple[str, float], ...] = ()

    def __post_init__(self):
        if not self.least < self.most or not self.least <= self.threshold <= self.most or any(w < 0 for _, w in self.weights):
            raise ValueError("a judge needs least < most, a threshold between them and weights of 0 or more")

    def __call__(self, row: dict) -> dict:
        out = self.function(row)
        out = dict(out) if isinstance(out, dict) else {"score": out}
        dimensions = {k: float(v) for k, v in (out.get("dimensions") or {}).items()}
        if self.weights:
            out["score"] = sum(w * dimensions[name] for name, w in self.weights)
        score = float(out["score"])
        if not self.least <= score <= self.most:
            raise ValueError(f"score {score} is not between {self.least} and {self.most}")
        return {"score": score, "passed": bool(out.get("pass", score >= self.threshold)), "comment": out.get("comment"), "dimensions": dimensions}


def judged(df: DataFrame, judge: Judge, keep: list[str] | None = None) -> DataFrame:
    """keep, score, passed, comment, dimensions (a map), error."""
    return processed(df, judge, "score double, passed boolean, comment string, dimensions map<string,double>", keep)

"""Row filters by field, operator and value; sorts that decide a column's type as a whole; prefix-stable samples."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPERATORS = ("!=", "!~", ">=", "<=", "=", "~", ">", "<")
ITEM = re.compile(r"^\s*(len\()?`?([\w.\-]+)`?(\))?\s*(!=|!~|>=|<=|=|~|>|<)\s*(.*?)\s*$", re.S)


def condition(value: Column, op: str, operand: str) -> Column:
    """A missing or unfit value never matches, also under != and !~. '=' compares text, '<' and its like compare numbers."""
    text = value.cast("string")
    if op in ("=", "!="):
        c = text == operand if op == "=" else text != operand
    elif op in ("~", "!~"):
        re.compile(operand)
        c = F.rlike(text, F.lit(operand))
        c = c if op == "~" else ~c
    elif op in (">", ">=", "<", "<="):
        number, x = float(operand), text.try_cast("double")
        c = {">": x > number, ">=": x >= number, "<": x < number, "<=": x <= number}[op]
    else:
        raise ValueError(f"unknown operator {op!r}")
    return F.coalesce(c, F.lit(False))


def where(df: DataFrame, *items: str, json_column: str | None = None) -> DataFrame:
    """Rows that meet all items 'field op value' or 'len(field) op value'. Fields beyond the columns are looked for in json_column."""
    for item in items:
        m = ITEM.match(item)
        if not m or bool(m[1]) != bool(m[3]):
            raise ValueError(f"not a filter: {item!r}")
        operand = m[5][1:-1] if len(m[5]) > 1 and m[5][0] == m[5][-1] and m[5][0] in "'\"" else m[5]
        if m[2] in df.columns:
            value = F.col(f"`{m[2]}`")
        elif json_column:
            value = F.get_json_object(json_column, f"$['{m[2]}']")
        else:
            value = F.lit(None).cast("string")
        df = df.where(condition(F.length(value.cast("string")) if m[1] else value, m[4], operand))
    return df


def numeric(df: DataFrame, field: str) -> bool:
    """Whether all present values of a field are numbers: one row, from partial results."""
    c = F.col(field).cast("string")
    return df.agg(F.count_if(c.isNotNull() & c.try_cast("double").isNull())).first()[0] == 0


def ordering(df: DataFrame, field: str, descending: bool = False) -> Column:
    """Sort key: numbers if the whole column is numeric, else text; missing values last either way."""
    c = F.col(field).cast("string")
    c = c.try_cast("double") if numeric(df, field) else c
    return c.desc_nulls_last() if descending else c.asc_nulls_last()


def sample_n(df: DataFrame, n: int, seed: int, row_id: str) -> DataFrame:
    """n rows in the order of a stable key (a top-n, not a global sort); a smaller n gives a prefix of it."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string"))), row_id).limit(n)


def sample_share(df: DataFrame, percent: float, seed: int, row_id: str) -> DataFrame:
    """Rounded percent of the rows, at most all: the same rows as sample_n of that many.

    The key at which the share ends is found by counting key prefixes twice (4,096 counts each), so that no task sorts
    more than the rows of one prefix.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string")))
    keyed = df.withColumn("__key", F.coalesce(key, F.lit("")))
    total = df.count()
    left, prefix, whole = min(total, int(total * percent / 100 + 0.5)), "", F.lit(False)
    for size in (3, 6):
        counts = keyed.where(F.startswith("__key", F.lit(prefix))).groupBy(F.substring("__key", 1, size).alias("p")).count().orderBy("p").collect()
        for r in counts:
            if r["count"] > left:
                whole = whole | (F.startswith("__key", F.lit(prefix)) & (F.substring("__key", 1, size) < r["p"]))
                prefix = r["p"]
                break
            left -= r["count"]
        else:
            return keyed.where(whole | F.startswith("__key", F.lit(prefix))).drop("__key")
    edge = keyed.where(F.startswith("__key", F.lit(prefix))).orderBy("__key", row_id).limit(left)
    return keyed.where(whole).unionByName(edge).drop("__key")

"""Translation queues: rows to translate, estimated sizes, and checks of what comes back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.functions import text as T


FIELDS = ("question", "options", "answer", "solution", "context")


def queue(records: DataFrame) -> DataFrame:
    """Records in neither zh nor en, with digits made ASCII and a mark on answers that are text."""
    d = records.where(~T.null_empty(F.col("lang")).isin("", "zh", "en"))
    return d.withColumns({"answer": T.ascii_digits(T.null_empty(F.col("answer"))), "answer_is_text": T.need_translate(F.col("answer"))})


def problems(source: str, result: str, lang: Column) -> Column:
    """Codes of what a translation of a question got wrong; an empty array if nothing."""
    a, b = T.null_empty(F.col(source)), T.null_empty(F.col(result))
    ratio = F.length(b) / F.greatest(F.length(a), F.lit(1))
    return F.when(T.strip(b) == "", F.array(F.lit("empty_question"))).otherwise(F.array_compact(F.array(
        F.when(~F.equal_null(T.numbers(a), T.numbers(b)), "numbers_changed"),
        F.when(T.latex_count(a) != T.latex_count(b), "latex_changed"),
        F.when((ratio < 0.15) | (ratio > 4.0), "length_ratio"),
        F.when(T.residual_ratio(b, lang) > 0.2, "source_script_left"),
    )))


def all_problems(source: dict[str, Column], result: dict[str, Column], lang: Column) -> Column:
    """Codes with their fields, of all fields of a translation: source and result by name, options as arrays; a field the result hasn't is not compared."""
    text = lambda d, k: T.null_empty(d[k])
    listed = lambda c: F.array_join(F.coalesce(c, F.array().cast("array<string>")), "\n")
    of = lambda d, k: listed(d[k]) if k == "options" else text(d, k)
    both = [k for k in FIELDS if k in source and k in result]
    checks = []
    if "options" in both:
        checks.append(F.when(F.size(F.coalesce(source["options"], F.array())) != F.size(F.coalesce(result["options"], F.array())), "options_count"))
    for k in ("question", "options", "answer"):
        if k in both:
            checks.append(F.when(result[k].isNotNull() & ~F.equal_null(T.numbers(of(source, k)), T.numbers(of(result, k))), f"numbers_changed:{k}"))
    for k in ("question", "solution"):
        if k in both:
            checks.append(F.when(result[k].isNotNull() & (T.latex_count(text(source, k)) != T.latex_count(text(result, k))), f"latex_changed:{k}"))
    a, b = text(source, "question"), text(result, "question")
    ratio = F.length(b) / F.greatest(F.length(a), F.lit(1))
    checks += [F.when((a != "") & ((ratio < 0.15) | (ratio > 4.0)), "length_ratio"), F.when(T.residual_ratio(b, lang) > 0.2, "source_script_left")]
    return F.when(T.strip(b) == "", F.array(F.lit("empty_question"))).otherwise(F.array_compact(F.array(*checks)))


def remaining(todo: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Rows that are not done yet, to go on after an interruption."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


def payload(records: DataFrame) -> dict[str, Column]:
    """payload (JSON of the fields that are to be translated) and keys: what isn't empty, the answer only where it is text."""
    kept = {c: F.nullif(T.null_empty(F.col(c)), F.lit("")) for c in FIELDS if c != "options"}
    kept["options"] = F.when(F.size("options") > 0, F.col("options"))
    kept["question"] = T.null_empty(F.col("question"))
    kept["answer"] = F.when(F.col("answer_is_text"), kept["answer"])
    return {"payload": F.to_json(F.struct(*[kept[c].alias(c) for c in FIELDS])), "keys": F.array_compact(F.array(*[F.when(kept[c].isNotNull(), c) for c in FIELDS]))}


def filled_in(source: Column, result: Column, name: str) -> tuple[Column, Column]:
    """(the translated field, or the source where it is blank; a warning or null)."""
    blank = T.strip(result) == ""
    return F.when(blank, source).otherwise(result), F.when(blank & (T.null_empty(source) != ""), f"kept_original:{name}")

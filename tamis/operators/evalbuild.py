"""Evaluation sets from normalised records: admission with reasons, dedupe, stratified caps, the final columns, the funnel.

Records have the columns of ``sources.writers.record`` and an id; metadata is JSON text.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamis.functions.text import final_answer, norm_question, null_empty, reasoning, strip
from tamis.operators.evalset import DEFAULT_CAP, EVAL_SPLITS, SPECIAL_CAPS, capped, cleaned, first_of_each, numbered, sample_key, stratified

# Languages kept, categories left out, and where a dataset's subject stands in its metadata.
KEPT_LANGS, LEFT_OUT = ("zh", "en"), ("code",)
SUBJECT_KEYS = {
    "CMMLU": "subject", "ceval-data": "subject", "ChineseSimpleQA": "primary_category", "SafetyBench": "category", "AlignBench": "category", "longbench-data": "subtask",
    "mathqa": "category", "legalbench": "task_name", "LawBench": "task_name", "CUAD": "clause_type", "apex-agents": "domain",
}
OTHER_SUBJECT_KEYS = ("subject", "primary_category", "subtask", "category", "dataset")
NO_SUBJECTS = ("open", "unknown", "none", "n/a")
COLUMNS = ("id", "source", "category", "task_type", "lang", "split", "subject", "difficulty", "variant", "question", "context", "options", "answer", "solution", "extra")
SIMPLE_COLUMNS = ("id", "pair_id", "question", "answer", "lang", "source", "difficulty", "reasoning_steps", "solution")
EXTRA_CHARS = 500
STRATA = ["task_type", "subject", "difficulty", "variant"]


def field(metadata: Column, name: str) -> Column:
    return strip(F.get_json_object(metadata, f"$['{name}']"))


def paper(c: Column) -> Column:
    """An exam paper's name: without brackets, its Roman number as one capital letter."""
    bare = strip(F.regexp_replace(strip(c), r"^[（(]\s*|\s*[）)]$", ""))
    bare = F.translate(bare, "ⅰⅱⅲⅳ", "ⅠⅡⅢⅣ")
    for small, capital in (("iii", "Ⅲ"), ("ii", "Ⅱ"), ("i", "Ⅰ")):
        bare = F.regexp_replace(bare, rf"(?i)(新课标)\s*{small}\s*$", f"$1{capital}")
    return bare


def exam_subject(file: Column) -> Column:
    """The subject between the years and the kind of question in a file's name."""
    return F.regexp_extract(strip(file), r"^\d{4}(?:-\d{4})?_(.+?)(?:_MCQs|_Open-ended_Questions|_Fill-in-the-Blank|_Fill_in_Blanks)?\.js(?:on)?$", 1)


def subjects(dataset: Column, metadata: Column) -> dict[str, Column]:
    """subject, difficulty and variant of a record."""
    own = F.lit("")
    for key in sorted(set(SUBJECT_KEYS.values())):
        own = F.when(dataset.isin(*[d for d, k in SUBJECT_KEYS.items() if k == key]), field(metadata, key)).otherwise(own)
    general = F.coalesce(F.nullif(own, F.lit("")), *[F.nullif(field(metadata, k), F.lit("")) for k in OTHER_SUBJECT_KEYS], F.lit(""))
    general = F.when(F.lower(general).isin(*NO_SUBJECTS), "").otherwise(general)
    exam = dataset == "GAOKAO-Bench"
    return {
        "subject": F.when(exam, exam_subject(field(metadata, "subject_file"))).otherwise(general),
        "difficulty": F.when(exam, "").otherwise(field(metadata, "level")),
        "variant": F.when(exam, paper(field(metadata, "category"))).otherwise(field(metadata, "perturbation_type")),
    }


def extra(metadata: Column) -> Column:
    """Metadata without the context and without empty values, as JSON of bounded length."""
    kept = F.map_filter(F.try_parse_json(metadata).cast("map<string,variant>"), lambda k, v: (k != "context") & ~F.to_json(v).isin("null", '""', "[]"))
    text = F.when(F.size(kept) > 0, F.to_json(kept)).otherwise("")
    return F.when(F.length(text) > EXTRA_CHARS, F.concat(F.substring(text, 1, EXTRA_CHARS), F.lit("…"))).otherwise(text)


def admitted(records: DataFrame, split_default: str = "unspecified") -> DataFrame:
    """All records, cleaned, with ``dropped``: code, lang, invalid or null, and reject_reason for the invalid ones; context and its hash, key of equal questions, subject, difficulty, variant, extra."""
    d = cleaned(records.withColumn("split", F.when(null_empty(F.col("split")) == "", split_default).otherwise(F.col("split"))))
    dropped = F.when(null_empty(F.col("category")).isin(*LEFT_OUT), "code").when(~null_empty(F.col("lang")).isin(*KEPT_LANGS), "lang").when(F.col("reject_reason").isNotNull(), "invalid")
    context = field(F.col("metadata"), "context")
    d = d.withColumns({"dropped": dropped, "context": context, "nq": F.md5(norm_question(F.col("question"))), "context_hash": F.when(context == "", "").otherwise(F.substring(F.md5(context), 1, 12))})
    return d.withColumns(subjects(F.col("dataset"), F.col("metadata")) | {"extra": extra(F.col("metadata"))})


def usable(split: Column) -> Column:
    return split.isin(*EVAL_SPLITS)


def deduped(good: DataFrame, with_context: bool = True) -> DataFrame:
    """The first record, by dataset and id, of each language, question and (if asked for) context."""
    key = [F.col("lang"), F.col("nq"), *([F.col("context_hash")] if with_context else [])]
    return first_of_each(good, key, ["dataset", "id"])


def picked(pool: DataFrame, seed: str, policy: str = "test-only", caps: dict[str, int] | None = None, default: int = DEFAULT_CAP) -> DataFrame:
    """Up to each dataset's cap, dealt over its strata. policy: test-only, test-first or all."""
    if policy not in ("test-only", "test-first", "all"):
        raise ValueError(f"unknown policy {policy!r}")
    caps = SPECIAL_CAPS | (caps or {})
    pool = pool.where(usable(F.col("split"))) if policy == "test-only" else pool
    rank = F.when(usable(F.col("split")), 0).otherwise(1) if policy != "all" else F.lit(0)
    dealt = stratified(pool, "dataset", STRATA, sample_key(seed, "dataset", "id"), "id", max([default, *caps.values()]), rank)
    return capped(dealt, "dataset", caps, default)


def built(records: DataFrame, seed: str, policy: str = "test-only", caps: dict[str, int] | None = None, default: int = DEFAULT_CAP, exclude: tuple[str, ...] = (), split_default: str = "unspecified") -> DataFrame:
    """The evaluation set: COLUMNS, with running ids over the order of source and a stable key."""
    good = admitted(records, split_default).where("dropped is null")
    pool = deduped(good).where(~F.col("dataset").isin(*exclude)) if exclude else deduped(good)
    out = picked(pool, seed, policy, caps, default).withColumns({"key": sample_key(seed, "dataset", "id"), "everything": F.lit(0)})
    out = numbered(out.withColumnRenamed("id", "orig"), "everything", ["dataset", "key"])
    number = F.lpad((F.col("n") + 1).cast("string"), 5, "0")
    options = F.when(F.size("options") > 0, F.to_json("options")).otherwise("")
    return out.withColumns({"source": F.col("dataset"), "id": F.concat("dataset", F.lit("-"), F.when(F.col("n") < 99_999, number).otherwise((F.col("n") + 1).cast("string"))), "options": options}).select(*COLUMNS)


def unknown(records: DataFrame, exclude: tuple[str, ...]) -> list[str]:
    """Names to exclude that no record has."""
    names = {r[0] for r in records.where(F.col("dataset").isin(*exclude)).select("dataset").distinct().collect()}  # at most the names given
    return sorted(set(exclude) - names)


def funnel(records: DataFrame, seed: str, caps: dict[str, int] | None = None, default: int = DEFAULT_CAP) -> DataFrame:
    """What is left of each dataset at each step: raw, code, lang, invalid, valid, duplicate, pool, train, usable, cap, picked, coverage, band."""
    every = admitted(records)
    at = lambda name: F.count_if(F.col("dropped") == name).alias(name)
    first = every.groupBy("dataset").agg(F.count(F.lit(1)).alias("raw"), at("code"), at("lang"), at("invalid"), F.count_if(F.col("dropped").isNull()).alias("valid"))
    pool = deduped(every.where("dropped is null"), with_context=False)
    second = pool.groupBy("dataset").agg(F.count(F.lit(1)).alias("pool"), F.count_if(usable(F.col("split"))).alias("usable"))
    third = picked(pool, seed, "test-only", caps, default).groupBy("dataset").agg(F.count(F.lit(1)).alias("picked"))
    d = first.join(second, "dataset", "left").join(third, "dataset", "left").fillna(0, ["pool", "usable", "picked"])
    named = SPECIAL_CAPS | (caps or {})
    cap = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in named.items() for x in kv]), F.col("dataset")), F.lit(default))
    share = F.col("picked") / F.col("raw")
    d = d.withColumns({"duplicate": F.col("valid") - F.col("pool"), "train": F.col("pool") - F.col("usable"), "cap": F.when(F.col("usable") > 0, cap).otherwise(0).cast("long"), "coverage": F.round(100 * share, 1), "band": F.when(F.col("picked") == 0, "none").when(share < 0.05, "low").otherwise("")})
    return d.select("dataset", "raw", "code", "lang", "invalid", "valid", "duplicate", "pool", "train", "usable", "cap", "picked", "coverage", "band")


def reasons(records: DataFrame) -> DataFrame:
    """Rejects by dataset and reason, with the sum over all of them under the dataset ''."""
    bad = admitted(records).where("dropped = 'invalid'").withColumn("dataset", null_empty(F.col("dataset")))
    out = bad.groupingSets([["dataset", "reject_reason"], ["reject_reason"]], "dataset", "reject_reason").agg(F.count(F.lit(1)).alias("n"))
    return out.withColumn("dataset", null_empty(F.col("dataset")))


def funnel_totals(steps: DataFrame) -> DataFrame:
    """The rows of funnel with one for all under the dataset '': sums, its own coverage, and the names of those with nothing (none) and with little (low) picked."""
    sums = ("raw", "code", "lang", "invalid", "valid", "duplicate", "pool", "train", "usable", "cap", "picked")
    named = lambda band: F.array_join(F.sort_array(F.collect_set(F.when(F.col("band") == band, F.col("dataset")))), ",")
    d = steps.groupingSets([["dataset"], []], "dataset").agg(F.grouping_id().alias("level"), *[F.sum(c).alias(c) for c in sums], named("none").alias("none"), named("low").alias("low"))
    whole = F.col("level") == 1
    share = F.when(F.col("raw") > 0, F.round(100 * (F.col("picked") / F.col("raw")), 1)).otherwise(0.0)
    return d.select(F.when(whole, "").otherwise(F.col("dataset")).alias("dataset"), *sums, share.alias("coverage"), *[F.when(whole, F.col(c)).otherwise("").alias(c) for c in ("none", "low")])


def difficulty_order(c: Column) -> Column:
    """'Level n' by n first (9 where it is no number), then low, medium, high, top, then others."""
    tail = F.regexp_extract(c, r"^Level (.*)$", 1)
    named = F.element_at(F.create_map(*[F.lit(x) for kv in (("low", 0), ("medium", 1), ("high", 2), ("top", 3)) for x in kv]), F.lower(strip(c)))
    return F.when(F.startswith(c, F.lit("Level ")), F.struct(F.lit(0).alias("a"), F.when(F.rlike(tail, F.lit(r"^\d+$")), tail.try_cast("int")).otherwise(9).alias("b"))).otherwise(F.struct(F.lit(1).alias("a"), F.coalesce(named, F.lit(8)).alias("b")))


def steps_order(c: Column) -> Column:
    """Numbers by value, what is no number first."""
    return F.when(F.rlike(c, F.lit(r"^\d+$")), c.try_cast("int")).otherwise(-1)


def fill_rates(rows: DataFrame, *columns: str) -> DataFrame:
    """column, filled, rows, share: how many rows have a value there."""
    counts = rows.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(null_empty(F.col(c)) != "").alias(c) for c in columns])
    stack = counts.select("rows", F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("filled")) for c in columns])).alias("c"))
    return stack.select("c.column", "c.filled", "rows", F.when(F.col("rows") > 0, F.round(F.col("c.filled") / F.col("rows"), 4)).otherwise(0.0).alias("share"))


def counts_document(rows: DataFrame, singles: tuple[str, ...], pairs: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """A statistics document as one table: section, key, sub, n. Sections are columns or pairs of columns; one pass over the rows."""
    cells = [F.struct(F.lit(c).alias("section"), null_empty(F.col(c)).alias("key"), F.lit("").alias("sub")) for c in singles]
    cells += [F.struct(F.lit(f"{a}_{b}").alias("section"), null_empty(F.col(a)).alias("key"), null_empty(F.col(b)).alias("sub")) for a, b in pairs]
    cells.append(F.struct(F.lit("total").alias("section"), F.lit("").alias("key"), F.lit("").alias("sub")))
    return rows.select(F.explode(F.array(*cells)).alias("c")).groupBy("c.section", "c.key", "c.sub").agg(F.count(F.lit(1)).alias("n"))


# --- the small set of easy questions -------------------------------------------------------------


def stable_uniform(seed: int, key: Column) -> Column:
    """A number in [0, 1) from a seed and a key."""
    hexed = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(hexed, 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def worked(rows: DataFrame) -> DataFrame:
    """rows: id, question, answer with working and a final answer: adds final, steps, key."""
    a = null_empty(F.col("answer"))
    marked = F.contains(a, F.lit("####"))
    solution = F.when(marked, reasoning(a)).otherwise(strip(a))
    return rows.withColumns({"final": F.when(marked, null_empty(final_answer(a))).otherwise(""), "solution": solution, "steps": F.regexp_count(solution, F.lit("<<")).cast("long"), "key": norm_question(F.col("question"))})


def parallel(first: DataFrame, second: DataFrame, solved: DataFrame) -> DataFrame:
    """Pairs of rows by place (id ending in -n), as far as both go, with steps and solution of the solved row of the same text (the last one)."""
    place = lambda d: d.withColumn("at", F.regexp_extract("id", r"(\d+)$", 1).cast("long"))
    known = solved.groupBy("key").agg(F.max_by(F.struct("steps", "solution"), "order").alias("s"))
    a, b = place(first).alias("a"), place(second).alias("b")
    both = a.join(b, F.col("a.at") == F.col("b.at")).select(F.col("a.at").alias("at"), *[F.col(f"{x}.{c}").alias(f"{x}_{c}") for x in "ab" for c in ("id", "question", "answer", "lang")])
    both = both.withColumn("key", norm_question(F.col("a_question"))).join(known, "key", "left")
    steps, solution = F.coalesce("s.steps", F.lit(0)), F.coalesce("s.solution", F.lit(""))
    sides = F.explode(F.array(*[F.struct(*[F.col(f"{x}_{c}").alias(c) for c in ("id", "question", "answer", "lang")]) for x in "ab"]))
    return both.select("at", steps.alias("reasoning_steps"), solution.alias("solution"), sides.alias("r")).select("at", "r.*", "reasoning_steps", "solution")


def zipped(first: DataFrame, second: DataFrame, order: list[str]) -> DataFrame:
    """Rows of two tables side by side by their place in an order, as far as both go: at, a, b, and unpaired, the rows that the longer one has more."""
    side = lambda d: numbered(d.withColumn("everything", F.lit(0)), "everything", order).select("n", F.struct(*d.columns).alias("row"))
    a, b = side(first), side(second)
    both = a.select(F.col("n").alias("at"), F.col("row").alias("a")).join(b.select(F.col("n").alias("at"), F.col("row").alias("b")), "at", "full_outer")
    rest = both.agg(F.count_if(F.col("a").isNull() | F.col("b").isNull()).alias("unpaired"))
    return both.where("a is not null and b is not null").crossJoin(F.broadcast(rest))  # one row


def supplement(solved: DataFrame, used: DataFrame, most_steps: int, n: int, seed: int) -> DataFrame:
    """The n easiest solved rows whose text isn't used yet: by steps, then by a stable number; a smaller n gives a prefix."""
    pool = solved.where((F.col("steps") <= most_steps) & (F.col("final") != "")).join(used.select(norm_question(F.col("question")).alias("key")).distinct(), "key", "left_anti")
    return pool.orderBy("steps", stable_uniform(seed, F.col("id")), "id").limit(n)


# --- unions ------------------------------------------------------------------------------------


def strict_union(frames: list[DataFrame]) -> DataFrame:
    """Rows of tables whose columns are the same, in the same order; others are an error."""
    for d in frames[1:]:
        if d.columns != frames[0].columns:
            raise ValueError(f"columns differ: {frames[0].columns} and {d.columns}")
    return reduce(DataFrame.unionByName, frames)


def union_of_headers(frames: list[DataFrame]) -> DataFrame:
    """Rows of tables with different columns: all columns in the order of their first table, missing values null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merged_counts(keys: list[str], frames: dict[str, DataFrame]) -> DataFrame:
    """Counts (keys, n) of several tables side by side, 0 where one has no such key."""
    out = None
    for name, d in frames.items():
        own = d.select(*keys, F.col("n").alias(name))
        if out is None:
            out = own
            continue
        left, right = out.alias("l"), own.alias("r")
        same = reduce(and_, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
        out = left.join(right, same, "full_outer").select(*[F.coalesce(f"l.{k}", f"r.{k}").alias(k) for k in keys], *[F.col(f"l.{c}") for c in out.columns if c not in keys], F.col(f"r.{name}"))
    return out.fillna(0, list(frames))


def content_hash(df: DataFrame) -> DataFrame:
    """rows, row_hash of a table: the same for the same rows in any order."""
    row = F.md5(F.to_json(F.struct(*sorted(df.columns))))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.md5(F.concat_ws(":", F.count(F.lit(1)).cast("string"), F.sum(F.conv(F.substring(row, 1, 12), 16, 10).cast("decimal(20,0)")).cast("string"), F.sum(F.conv(F.substring(row, 13, 12), 16, 10).cast("decimal(20,0)")).cast("string"))).alias("table_hash"))


def top_languages(df: DataFrame, group: str, lang: str, most: int = 4) -> DataFrame:
    """group, langs: the most frequent languages with their counts, and '…(n)' for the others."""
    counts = df.groupBy(group, lang).agg(F.count(F.lit(1)).alias("n"))
    ranked = counts.withColumn("r", F.row_number().over(W.partitionBy(group).orderBy(F.desc("n"), lang)))
    named = F.array_sort(F.collect_list(F.when(F.col("r") <= most, F.struct("r", F.concat(null_empty(F.col(lang)), F.lit(":"), F.col("n").cast("string")).alias("t")))))
    more = F.count_if(F.col("r") > most)
    listed = F.array_join(F.transform(named, lambda x: x["t"]), " ")
    return ranked.groupBy(group).agg(listed.alias("langs"), more.alias("more")).select(group, F.concat("langs", F.when(F.col("more") > 0, F.concat(F.lit(" …("), F.col("more").cast("string"), F.lit(")"))).otherwise("")).alias("langs"))

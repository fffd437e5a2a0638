"""Evaluation sets: cleaning with reasons, first-wins dedupe, stratified prefix-stable samples, running ids."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamis.functions.text import final_answer, null_empty, reasoning, stable_key, strip
from tamis.scratch import written

# Splits that count as evaluation, caps, and below the reject codes.
EVAL_SPLITS = ("test", "testmini", "validation", "val", "dev", "unspecified")
DEFAULT_CAP = 2000
SPECIAL_CAPS = {"longbench-data": 500, "CUAD": 300}


def cleaned(records: DataFrame) -> DataFrame:
    """records: question, answer, options, solution, split, and metadata if there. Repairs answers and options; reject_reason is null for good rows."""
    q, a = strip(F.col("question")), strip(F.col("answer"))
    options = F.transform(F.coalesce("options", F.array().cast("array<string>")), strip)
    has_gsm = F.contains(a, F.lit("####"))
    final = final_answer(a)
    d = records.withColumns({"question": q, "answer": F.when(has_gsm, final).otherwise(a), "solution": F.when(has_gsm & (null_empty(F.col("solution")) == ""), reasoning(a)).otherwise(null_empty(F.col("solution"))), "options": options, "__raw": a})
    # Letter prefixes go only where every option has one; the answer's goes with them.
    prefix = r"^[a-e]\s*[.)]\s+"
    o = F.col("options")
    prefixed = (F.size(o) > 0) & F.forall(o, lambda x: F.rlike(x, F.lit(prefix)))
    d = d.withColumns({"answer": F.when(prefixed, F.regexp_replace("answer", prefix, "")).otherwise(F.col("answer")), "options": F.when(prefixed, F.transform(o, lambda x: F.regexp_replace(x, prefix, ""))).otherwise(o)})
    mean = F.aggregate(o, F.lit(0), lambda s, x: s + F.length(x)) / F.size(o)
    is_letter = (F.size(o) > 0) & F.rlike("answer", F.lit("^[A-H]{1,4}$")) & (mean > 3) & ~F.forall(o, lambda x: F.rlike(x, F.lit("^[A-H]$")))
    letters = F.filter(F.split("answer", ""), lambda x: x != "")
    beyond = F.exists(letters, lambda x: F.ascii(x) - 65 >= F.size(o))
    d = d.withColumns({"__letter": is_letter, "__beyond": F.when(is_letter, beyond).otherwise(False)})
    text = F.array_join(F.transform(letters, lambda x: F.try_element_at(o, F.ascii(x) - 64)), "|")
    d = d.withColumn("answer", F.when(F.col("__letter") & ~F.col("__beyond"), text).otherwise(F.col("answer")))
    found = F.exists(o, lambda x: F.contains(x, F.col("answer")) | F.contains(F.col("answer"), x))
    reason = (
        F.when(F.col("question") == "", "empty_question").when(F.length("question") < 2, "question_too_short").when(F.col("__raw") == "", "empty_answer")
        .when(F.contains("__raw", F.lit("####")) & F.col("answer").isNull(), "malformed_gsm_answer").when(F.size(o) == 1, "too_few_options")
        .when(F.col("__beyond"), "option_missing_for_letter").when((F.size(o) > 0) & ~F.col("__letter") & ~found, "answer_not_in_options")
    )
    split = F.when(null_empty(F.col("split")) == "", "unspecified").otherwise(F.col("split"))
    if "metadata" in records.columns:  # a letter that became its option's text stays in the metadata
        fields = F.map_filter(F.coalesce(F.try_parse_json("metadata").cast("map<string,variant>"), F.create_map().cast("map<string,variant>")), lambda k, _: k != "answer_letter")
        letter = F.create_map(F.lit("answer_letter"), F.to_variant_object(F.struct(F.col("__raw").alias("v"))))
        letter = F.transform_values(letter, lambda _, v: F.variant_get(v, "$.v", "variant"))
        d = d.withColumn("metadata", F.when(F.col("__letter") & ~F.col("__beyond"), F.to_json(F.map_concat(fields, letter))).otherwise(F.col("metadata")))
    return d.withColumns({"reject_reason": reason, "split": split}).drop("__raw", "__letter", "__beyond")


def first_of_each(df: DataFrame, key: list[Column], order: list) -> DataFrame:
    """The first row of each key. A window's group limit leaves one row a key and task before the shuffle, so a key that many rows share is no task of its own."""
    first = F.row_number().over(W.partitionBy(*key).orderBy(*order))
    return df.select(F.struct("*").alias("row"), first.alias("nth")).where("nth = 1").select("row.*")


def stratified(df: DataFrame, group: str, strata: list[str], key: Column, order: str, cap: int, rank: Column | None = None) -> DataFrame:
    """Up to cap rows a group, dealt round robin over its strata (largest first), in the order of a stable key.

    A smaller cap picks a prefix of what a larger cap picks. Strata are counted by partial sums, and each is cut to the cap
    before and after the shuffle (a window's group limit), so a stratum of any size sends few rows to its task.
    """
    names = [group, *strata]
    counted = df.groupBy(*names).agg(F.count(F.lit(1)).alias("stratum_n"), F.min(order).alias("stratum_first"))
    counted = counted.select(*[F.col(n).alias(f"__{i}") for i, n in enumerate(names)], "stratum_n", "stratum_first")
    i = F.row_number().over(W.partitionBy(*names).orderBy(*([rank] if rank is not None else []), key, order))
    d = df.withColumn("i", i).where(F.col("i") <= cap)
    same = [F.col(n).eqNullSafe(F.col(f"__{k}")) for k, n in enumerate(names)]
    d = d.join(counted, reduce(and_, same)).drop(*[f"__{k}" for k in range(len(names))])
    pick = F.row_number().over(W.partitionBy(group).orderBy("i", F.desc("stratum_n"), "stratum_first"))
    return d.withColumn("pick", pick).where(F.col("pick") <= cap)


def capped(df: DataFrame, source: str, caps: dict[str, int], default: int) -> DataFrame:
    """Rows whose pick is within their source's cap; the literal bound first lets Spark prune the window's groups."""
    cap = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in caps.items() for x in kv]), F.col(source)), F.lit(default)) if caps else F.lit(default)
    return df.where(F.col("pick") <= max([default, *caps.values()])).where(F.col("pick") <= cap)


def numbered(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds n: each row's place in its group from 0. Rows are range-partitioned, so that one group can span many tasks."""
    sort = [F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]]
    placed = df.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()})
    placed = written(placed, "numbered")  # parts and places must be the same below
    runs = placed.groupBy("__part", group).agg(F.min("__at").alias("__low"), F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(W.partitionBy(group).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # a row for each part
    runs = runs.select(F.col("__part").alias("__p"), F.col(group).alias("__g"), "__low", before.alias("__before"))
    runs = written(runs, "runs")  # so that its size is known: where it is small the rows themselves needn't be shuffled for the join
    joined = placed.join(runs, (F.col("__part") == F.col("__p")) & F.col(group).eqNullSafe(F.col("__g")))
    return joined.withColumn("n", F.col("__at") - F.col("__low") + F.col("__before")).select(*df.columns, "n")


def seq_ids(df: DataFrame, dataset: str, order: list[str], digits: int = 6) -> DataFrame:
    d = numbered(df, dataset, order)
    return d.withColumn("id", F.concat(F.col(dataset), F.lit("-"), F.lpad(F.col("n").cast("string"), digits, "0"))).drop("n")


def quota_sample(df: DataFrame, lang: str, source: str, key: Column, order: str, quota: int) -> DataFrame:
    """Up to quota rows a language, dealt round robin over its sources in the order of a stable key."""
    d = df.withColumn("i", F.row_number().over(W.partitionBy(lang, source).orderBy(key, order))).where(F.col("i") <= quota)
    return d.withColumn("pick", F.row_number().over(W.partitionBy(lang).orderBy("i", source))).where(F.col("pick") <= quota)


def language_quotas(df: DataFrame, lang: str, total: int) -> DataFrame:
    """lang, n, quota: an equal share of total, at most n; what is left goes round by one, the largest language first, to those with room.

    After k rounds a language has min(n, base + k) rows; the rounds that are whole are found on sums, the last is dealt by rank.
    """
    sizes = df.groupBy(lang).agg(F.count(F.lit(1)).alias("n"))  # a row for each language
    everything, by_size = W.partitionBy(), W.orderBy(F.desc("n"), lang)
    rising = W.orderBy("n", lang)
    below = F.coalesce(F.sum("n").over(rising.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    above = F.count(F.lit(1)).over(rising.rowsBetween(W.currentRow, W.unboundedFollowing))
    level = F.floor((F.lit(total) - below) / above)  # rows each if the smaller ones are full; the greatest of these is where it stands
    ranked = sizes.withColumn("__level", level).withColumn("__whole", F.max("__level").over(everything))
    ranked = ranked.withColumn("quota", F.least("n", "__whole"))
    left = F.lit(total) - F.sum("quota").over(everything)
    open_ = (F.col("n") > F.col("quota")).cast("int")
    turn = F.sum(open_).over(by_size.rowsBetween(W.unboundedPreceding, W.currentRow))
    return ranked.withColumn("quota", F.col("quota") + F.when((open_ == 1) & (turn <= left), 1).otherwise(0)).select(lang, "n", F.col("quota").cast("long").alias("quota"))


def sample_key(seed: int, source: str, row_id: str) -> Column:
    return stable_key(F.lit(seed), F.col(source), F.col(row_id))

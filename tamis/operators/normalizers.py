"""Normalisers of evaluation data: raw rows of a dataset become records of one schema, or rejects with a reason.

A raw row is ``file`` (its path below the corpus root), ``row`` (its fields, as VARIANT, so that JSON, CSV and Parquet
sources read alike), and where a dataset needs them ``at`` (its place in the file, from 0) and ``top`` (fields of the
file's outer object). Other columns go through. Every normaliser is a set of Column expressions; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.functions import parsers as P
from tamis.functions.text import canonical_name, final_answer, norm_lang, null_empty, reasoning, strip
from tamis.sources.writers import record

REGISTRY: dict[str, Dataset] = {}
LETTERS = ("A", "B", "C", "D")

# Fixed values all through: names of each dataset and of its fields, the constant fields of its records, and the codes of its rejects.


@dataclass(frozen=True)
class Dataset:
    name: str
    category: str
    fields: Callable[[], dict[str, Column]]
    prepare: Callable[..., DataFrame] | None = None


def dataset(name: str, category: str, prepare=None):
    def register(fields):
        REGISTRY[name] = Dataset(name, category, fields, prepare)
        return fields

    return register


def find(name: str) -> Dataset:
    """The dataset of a name, whatever its case and whether it is written with - or _; the first that matches."""
    key = lambda n: n.strip().replace("_", "-").casefold()
    for n, d in REGISTRY.items():
        if key(n) == key(name):
            return d
    raise KeyError(name)


def normalize(raw: DataFrame, name: str, **sides: DataFrame) -> DataFrame:
    """Records of a dataset's raw rows with reject_reason (null for good rows). sides: further tables that the dataset joins."""
    d = find(name)
    for column, kind in (("at", "long"), ("top", "variant")):
        if column not in raw.columns:
            raw = raw.withColumn(column, F.lit(None).cast(kind))
    carried = [c for c in raw.columns if c not in ("file", "row", "at", "top")]
    if d.prepare:
        raw = d.prepare(raw, **sides)
    fields = d.fields()
    reason = F.when(F.col("row").isNull(), "json_parse_error")
    for why, when in fields.pop("reject", {}).items():
        reason = reason.when(when, why)
    fixed = {"dataset": F.lit(d.name), "category": F.lit(d.category), "source_file": F.col("file")}
    return raw.select(*carried, *record(**(fixed | fields)), reason.alias("reject_reason"))


def skipped(normalized: DataFrame) -> DataFrame:
    """Rows and rejected rows by dataset and reason: dataset, reason ('' for good rows), n."""
    return normalized.groupBy("dataset", null_empty(F.col("reject_reason")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


# --- fields of a raw row -------------------------------------------------------------------


def get(name: str, kind: str = "string", of: str = "row") -> Column:
    return F.try_variant_get(of, f"$['{name}']", kind)


def text(*names: str) -> Column:
    """The first of some fields that isn't empty, as text; empty if none is."""
    return F.coalesce(*[F.nullif(get(n), F.lit("")) for n in names], F.lit(""))


def items(name: str) -> Column:
    return F.coalesce(get(name, "array<string>"), F.array().cast("array<string>"))


def is_list(name: str) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(get(name, "variant")), F.lit("ARRAY")), F.lit(False))


def as_map(column: str = "row") -> Column:
    return F.col(column).cast("map<string,string>")


def meta(*names: str, **values: Column) -> Column:
    """Fields by name, kept in their own types, and further values, as JSON; what is missing is left out."""
    return F.to_json(F.struct(*[get(n, "variant").alias(n) for n in names], *[v.alias(n) for n, v in values.items()]))


def rest(*names: str, **values: Column) -> Column:
    """All fields but the named ones, with further values, as JSON."""
    kept = F.map_filter(F.col("row").cast("map<string,variant>"), lambda k, _: ~k.isin(*names, *values))
    more = [F.create_map(F.lit(n), F.to_variant_object(F.array(v))) for n, v in values.items()]
    more = [F.transform_values(m, lambda _, v: F.try_variant_get(v, "$[0]", "variant")) for m in more]
    return F.to_json(F.map_concat(kept, *more) if more else kept)


def stem() -> Column:
    return F.regexp_extract("file", r"([^/]+?)(?:\.[^./]*)?$", 1)


def name() -> Column:
    return F.regexp_extract("file", r"([^/]+)$", 1)


def prefix() -> Column:
    """The file name's part before its first '-'."""
    return F.substring_index(name(), "-", 1)


def folder() -> Column:
    return F.regexp_extract("file", r"([^/]+)/[^/]+$", 1)


def number_text(c: Column) -> Column:
    """Text of a field that may be missing: empty then."""
    return null_empty(c)


def open_qa(question: Column, answer: Column, reason: str = "empty_question", lang: str = "en", **more) -> dict[str, Column]:
    """The plain case: a question, an answer, and a reject where the question is blank."""
    return {"task_type": F.lit("open_qa"), "lang": F.lit(lang), "question": question, "answer": answer, "reject": {reason: strip(question) == ""}} | more


def choice(letter: Column, options: Column) -> Column:
    """Text of the option that a letter names; empty if it names none."""
    return F.coalesce(F.when(letter.isin(*LETTERS), F.try_element_at(options, F.ascii(letter) - 64)), F.lit(""))


def lettered_columns(question: str, answer: str, reasons: dict[str, Column], **more) -> dict[str, Column]:
    """Questions whose options stand in columns A to D."""
    options = F.array(*[null_empty(get(x)) for x in LETTERS])
    letter = strip(get(answer))
    return {
        "task_type": F.lit("mcq"), "lang": F.lit("zh"), "question": text(question), "answer": choice(letter, options), "options": options,
        "reject": {k: v if v is not None else F.forall(options, lambda x: x == "") for k, v in reasons.items()},
    } | more


# --- mathematics ---------------------------------------------------------------------------


def _after_marks(c: Column) -> Column:
    return F.when(F.contains(c, F.lit("####")), null_empty(final_answer(c))).otherwise(strip(c))


@dataset("gsm8k", "math")
def _gsm8k():
    return open_qa(text("question"), _after_marks(text("answer")), solution=reasoning(text("answer")), split=prefix(), reject={"empty_question": text("question") == ""})


@dataset("PolyMath", "math")
def _polymath():
    return open_qa(text("question"), text("answer"), orig_id=text("id"), metadata=meta(level=stem())) | {"lang": folder()}


@dataset("aqua_rat", "math")
def _aqua_rat():
    options = F.transform(items("options"), P.lettered)
    letter = text("correct", "answer")
    answer = null_empty(P.text_of(options, letter))
    return open_qa(text("question"), answer, task_type=F.lit("mcq"), options=F.transform(options, lambda o: o["text"]), solution=text("rationale"), split=prefix(), metadata=meta(answer_letter=letter, choices=items("options")), reject={"empty_question": text("question") == "", "answer_letter_not_in_options": answer == ""})


@dataset("ChilleD_SVAMP", "math")
def _svamp():
    body, q = strip(get("Body")), strip(get("Question"))
    question = F.when((body == "") | (q == ""), F.concat(body, q)).otherwise(F.concat(body, F.when(F.endswith(body, F.lit(".")), " ").otherwise(". "), q))
    return open_qa(question, text("Answer"), solution=text("Equation"), split=prefix(), orig_id=text("ID"), metadata=meta(Type=text("Type")))


@dataset("MultiArith", "math")
def _multiarith():
    whole = F.concat(text("Body"), F.lit(" "), text("Question"))
    question = F.when(text("question", "input") != "", text("question", "input")).when(text("Body") != "", whole).otherwise("")
    return open_qa(strip(question), F.coalesce(get("final_ans"), get("answer"), get("Ans"), get("output")), split=stem(), orig_id=text("ID"))


@dataset("math", "math")
def _math():
    return open_qa(text("problem"), P.boxed(text("solution")), "empty_problem", solution=text("solution"), metadata=meta("level", "type"))


@dataset("mmath", "math")
def _mmath():
    return open_qa(text("question"), text("answer"), orig_id=F.coalesce(get("gid"), F.col("at").cast("string")), metadata=rest("question", "answer")) | {"lang": stem()}


def _with_options(raw: DataFrame) -> DataFrame:
    """Options as a column of their own, so that they are read once."""
    return raw.withColumn("found", P.marked_options(get("options")))


@dataset("mathqa", "math", _with_options)
def _mathqa():
    found, letter = F.col("found"), F.lower(strip(get("correct")))
    texts = F.transform(found, lambda o: o["text"])
    first = F.try_element_at(F.filter(found, lambda o: o["letter"] == letter), F.lit(1))["text"]
    return open_qa(text("Problem"), first, task_type=F.lit("mcq"), options=texts, solution=text("Rationale"), split=stem(), metadata=rest("Problem", "options", "correct", "Rationale", answer_letter=letter, choices=texts), reject={"empty_problem": strip(text("Problem")) == "", "no_options": F.size(found) == 0})


@dataset("apple_gsm_symbolic", "math")
def _symbolic():
    return open_qa(text("question"), text("answer"), split=F.lit("test"), orig_id=text("id"), metadata=rest("question", "answer", variant=folder()))


@dataset("gsm_plus", "math")
def _gsm_plus():
    return open_qa(text("question"), text("answer"), solution=text("solution"), split=prefix(), metadata=rest("question", "answer", "solution"))


@dataset("asdiv", "math")
def _asdiv():
    question = strip(F.concat_ws(" ", strip(get("Body")), strip(get("Question"))))
    return open_qa(question, strip(get("Answer")), orig_id=F.col("at").cast("string"), metadata=meta("Solution-Type", "Formula"))


@dataset("mathmist", "math")
def _mathmist():
    found, letter = P.choice_list(get("Multiple Choices"), is_list("Multiple Choices"), items("Multiple Choices")), F.upper(strip(get("Correct Answer")))
    mcq = F.size(found) > 0
    named = F.when(mcq & (letter != ""), F.try_element_at(F.filter(found, lambda o: o["letter"] == letter), F.lit(1))["text"])
    return open_qa(
        text("Question"), F.coalesce(F.nullif(named, F.lit("")), text("Exact Answer")), task_type=F.when(mcq, "mcq").otherwise("open_qa"), options=F.transform(found, lambda o: o["text"]), solution=text("Solution"),
        metadata=rest("Question", "Exact Answer", "Multiple Choices", "Correct Answer", "Solution", "Language", answer_letter=F.when(mcq, letter).otherwise(""), file_subdir=F.regexp_extract("file", r"Data/(.*)/[^/]+$", 1)),
        reject={"skipped_model_output_dir": F.contains("file", F.lit("Evaluation Results")) | F.contains("file", F.lit("Accuracy Check")), "empty_question": strip(text("Question")) == ""},
    ) | {"lang": F.when(text("Language") == "", "").otherwise(norm_lang(text("Language")))}


for _year in ("aime-2025", "aime-2026"):

    @dataset(_year, "math")
    def _aime():
        return open_qa(text("problem"), text("answer"), split=F.lit("test"), orig_id=text("problem_idx"), metadata=meta("problem_idx", "problem_type"))


@dataset("gsm1k", "math")
def _gsm1k():
    return open_qa(text("question"), text("answer"), split=F.lit("test"), orig_id=F.col("at").cast("string"))


# --- Chinese benchmarks ----------------------------------------------------------------------


@dataset("ceval-data", "chinese")
def _ceval():
    reasons = {"ceval_empty_question": text("question") == "", "ceval_no_options": None}
    return lettered_columns("question", "answer", reasons, solution=text("explanation"), split=prefix(), orig_id=text("id"), metadata=meta("explanation", subject=folder(), answer_letter=strip(get("answer"))))


@dataset("CMMLU", "chinese")
def _cmmlu():
    return lettered_columns("Question", "Answer", {"cmmlu_empty_question": text("Question") == ""}, split=folder(), orig_id=text(""), metadata=meta(subject=stem(), answer_letter=strip(get("Answer"))))


@dataset("fineval", "chinese")
def _fineval():
    reasons = {"fineval_empty_question": text("question") == "", "fineval_no_options": None}
    return lettered_columns("question", "answer", reasons, solution=text("explanation"), split=F.lit("dev"), orig_id=text("id", "\ufeffid"), metadata=meta(subject=F.replace(stem(), F.lit("_dev"), F.lit("")), answer_letter=strip(get("answer"))))


# Fixed value: the question of a long text whose task has none of its own, around the task's name.
LONG_TEXT_QUESTION = ("（长文本任务 ", "）请根据给定上下文完成该任务，参考答案见 answer。")


@dataset("longbench-data", "chinese")
def _longbench():
    blank = text("input") == ""
    given = F.coalesce(get("answers"), get("answer"), F.lit(""))
    field = F.coalesce(get("answers", "variant"), get("answer", "variant"))
    listed = F.from_json(F.when(F.startswith(F.schema_of_variant(field), F.lit("ARRAY")), given).otherwise(P.literal_json(given)), "array<string>")
    question = F.when(blank, F.concat(F.lit(LONG_TEXT_QUESTION[0]), stem(), F.lit(LONG_TEXT_QUESTION[1]))).otherwise(text("input"))
    lang = F.when(text("language").isin("zh", "en"), text("language")).otherwise("en")
    return {
        "task_type": F.lit("long_context"), "lang": lang, "question": question, "answer": F.coalesce(F.array_join(listed, "\n"), given), "split": F.lit("test"), "orig_id": text("_id"),
        "metadata": meta("context", "length", "dataset", "language", "_id", subtask=stem(), input_empty=blank),
    }


def _with_options_of(raw: DataFrame, question: Column, marker: str) -> DataFrame:
    """The options that a question holds (found), what stands before them (stem) and their texts by letter (named), each a column: worked out once a row, however many fields read it."""
    raw = raw.withColumn("__asked", question).withColumn("__marked", P.pairs(F.col("__asked"), marker)).withColumn("__found", P.from_a(F.col("__marked")))
    named = F.filter(F.array(*[P.text_of(F.col("__found"), F.lit(x)) for x in "ABCDE"]), lambda x: x.isNotNull())
    return raw.withColumns({"__stem": F.when(F.col("__found").isNotNull(), P.before_first(F.col("__asked"), marker)), "__named": named})


def _with_paper_options(raw: DataFrame) -> DataFrame:
    raw = _with_options_of(raw, text("question"), P.PAPER_OPTION)
    raw = raw.withColumn("__named", F.filter("__named", lambda x: x != ""))
    letters = F.when(is_list("answer"), items("answer")).otherwise(F.array(text("answer")))
    return raw.withColumns({"__mcq": F.contains(name(), F.lit("MCQ")) & F.coalesce(F.size("__named") >= 2, F.lit(False)), "__letters": letters})


@dataset("GAOKAO-Bench", "chinese", _with_paper_options)
def _gaokao():
    mcq, found, letters = F.col("__mcq"), F.col("__found"), F.col("__letters")
    texts = F.array_join(F.filter(F.transform(F.transform(letters, strip), lambda x: P.text_of(found, x)), lambda x: x != ""), " ")
    plain = F.array_join(letters, " ")
    return {
        "task_type": F.when(mcq, "mcq").otherwise("open_qa"), "lang": F.when(F.contains(name(), F.lit("English")), "en").otherwise("zh"), "split": F.lit("test"),
        "question": F.when(mcq, F.col("__stem")).otherwise(F.col("__asked")), "options": F.when(mcq, F.col("__named")), "solution": text("analysis"),
        "answer": F.coalesce(F.when(mcq, F.nullif(texts, F.lit(""))), plain),
        "metadata": meta("year", "category", "score", "index", keywords=get("keywords", of="top"), subject_file=name(), kind=F.when(F.contains("file", F.lit("Objective")), "objective").otherwise("subjective"), answer_letter=F.when(mcq, plain)),
        "reject": {"gaokao_empty_question": F.col("__asked") == ""},
    }


@dataset("AlignBench", "chinese")
def _alignbench():
    return open_qa(text("question"), text("reference"), lang="zh", task_type=F.lit("instruction_following"), split=F.lit("test"), orig_id=text("question_id"), metadata=meta("question_id", "category", "subcategory", "evidences"), reject={"alignbench_empty_question": text("question") == ""})


def _with_answers(raw: DataFrame, answers: DataFrame) -> DataFrame:
    """answers: lang, id, answer_row (VARIANT). Questions keep their place whether they have an answer or not."""
    tag = F.regexp_extract("file", r"_([a-z]+)\.[^.]*$", 1)
    keyed = answers.select(F.col("lang").alias("__lang"), F.col("id").cast("string").alias("__id"), F.col("answer_row").alias("side"))
    return raw.withColumn("__tag", tag).join(keyed, (F.col("__tag") == F.col("__lang")) & (number_text(get("id")) == F.col("__id")), "left")


@dataset("SafetyBench", "chinese", _with_answers)
def _safety():
    options, at = items("options"), get("answer", of="side").try_cast("int")
    answer = F.coalesce(F.when(at >= 0, F.try_element_at(options, at + 1)), F.lit(""))
    return {
        "task_type": F.lit("mcq"), "lang": F.col("__tag"), "split": F.lit("test"), "question": text("question"), "answer": answer, "options": options, "orig_id": text("id"),
        "metadata": meta(category=F.coalesce(get("category"), get("category", of="side"), F.lit("")), answer_idx=at), "reject": {"safety_empty_question": text("question") == ""},
    }


@dataset("ChineseSimpleQA", "chinese")
def _simpleqa():
    question, answer = F.coalesce(get("问题"), text("question")), F.coalesce(get("答案"), text("answer"))
    return open_qa(question, answer, lang="zh", split=F.lit("test"), metadata=rest("问题", "答案", "question", "answer"), reject={"simpleqa_empty_question": question == ""})


def _with_colon_options(raw: DataFrame) -> DataFrame:
    raw = _with_options_of(raw, F.regexp_replace(text("question"), r"^Question\s*[:：]\s*", ""), P.COLON_OPTION)
    many = F.endswith("file", F.lit("_mc.json"))
    return raw.withColumns({"__many": many, "__mcq": many & F.col("__found").isNotNull(), "__letter": F.regexp_extract(text("answer"), "([A-E])", 1)})


@dataset("HalluQA", "chinese", _with_colon_options)
def _hallu():
    many, mcq, letter = F.col("__many"), F.col("__mcq"), F.col("__letter")
    best = F.array_join(F.array_compact(F.array(*[F.nullif(get(f"Best Answer{k}"), F.lit("")) for k in range(1, 6)])), "\n")
    return {
        "task_type": F.when(mcq, "mcq").otherwise("open_qa"), "lang": F.lit("zh"), "split": F.lit("test"), "orig_id": F.when(many, text("question_id")),
        "question": F.when(mcq, F.col("__stem")).when(many, text("question")).otherwise(text("Question")),
        "answer": F.when(mcq, P.text_of(F.col("__found"), letter)).when(many, text("answer")).otherwise(best), "options": F.when(mcq, F.col("__named")),
        "metadata": F.when(many, meta(answer_letter=letter, task=F.lit("mc"))).otherwise(meta(source=text("Source"), task=F.lit("open"))),
        "reject": {"hallu_mc_empty_question": many & (text("question") == ""), "hallu_open_empty_question": ~many & (text("Question") == "")},
    }


# Names of the tasks.
LAW_TASKS = {"1-2": "法律知识问答", "3-1": "法条预测", "3-3": "罪名预测", "3-4": "刑期预测", "3-6": "案例单选"}


@dataset("LawBench", "chinese")
def _lawbench():
    question, answer = strip(get("question")), strip(get("answer"))
    found, letter = P.pairs(question, P.INLINE_OPTION), F.regexp_extract(answer, r"正确答案[:：]\s*([A-D])", 1)
    at = F.ascii(letter) - 64
    mcq = (F.size(found) >= 2) & (letter != "") & (at <= F.size(found))
    names = F.create_map(*[F.lit(x) for kv in LAW_TASKS.items() for x in kv])
    return {
        "task_type": F.when(mcq, "mcq").otherwise("open_qa"), "lang": F.lit("zh"), "split": F.lit("test"), "question": question,
        "answer": F.when(mcq, F.try_element_at(found, at)["text"]).otherwise(answer), "options": F.when(mcq, F.transform(found, lambda o: o["text"])),
        "metadata": meta("instruction", task_id=folder(), task_name=null_empty(F.try_element_at(names, folder())), answer_letter=letter, answer_raw=text("answer")),
        "reject": {"empty_question": question == "", "empty_answer": answer == ""},
    }


# --- code --------------------------------------------------------------------------------------


def _json_or_text(field: str) -> Column:
    """A field whose text may be JSON itself: parsed if it is."""
    return F.coalesce(F.try_parse_json(get(field)), get(field, "variant"))


@dataset("swe-bench-data", "code")
def _swe():
    names = ("repo", "base_commit", "test_patch", "hints_text", "created_at", "version", "environment_setup_commit")
    return {
        "task_type": F.lit("swe"), "question": text("problem_statement"), "answer": text("patch"), "split": F.regexp_extract(name(), "^(dev|test|train)", 1), "orig_id": text("instance_id"),
        "metadata": meta(*names, FAIL_TO_PASS=_json_or_text("FAIL_TO_PASS"), PASS_TO_PASS=_json_or_text("PASS_TO_PASS")),
        "reject": {"missing_problem_statement_or_instance_id": (strip(text("problem_statement")) == "") | (text("instance_id") == "")},
    }


@dataset("livecodebench-data", "code")
def _livecode():
    names = ("question_title", "platform", "contest_id", "contest_date", "starter_code", "difficulty", "tags")
    return {
        "task_type": F.lit("code_generation"), "question": text("question_content"), "answer": text("code", "canonical_solution", "solution"), "split": F.lit("test"), "orig_id": text("question_id"),
        "metadata": meta(*names, **{n: _json_or_text(n) for n in ("public_test_cases", "private_test_cases", "metadata")}),
        "reject": {"missing_question_content_or_id": (strip(text("question_content")) == "") | (text("question_id") == "")},
    }


@dataset("scicode", "code")
def _scicode():
    steps = F.coalesce(F.try_variant_get(_json_or_text("sub_steps"), "$", "array<variant>"), F.array().cast("array<variant>"))
    headers = F.array_compact(F.transform(steps, lambda s: F.nullif(F.try_variant_get(s, "$.function_header", "string"), F.lit(""))))
    return open_qa(
        text("problem_description_main"), F.array_join(headers, "\n\n"), task_type=F.lit("code_generation"), split=F.regexp_extract(stem(), "_(test|dev)$", 1), orig_id=text("problem_id"),
        metadata=meta("problem_name", "problem_io", "required_dependencies", "general_tests", problem_background=text("problem_background_main"), sub_steps=steps), reject={"scicode_empty_description": text("problem_description_main") == ""},
    )


@dataset("aider-polyglot", "code")
def _aider():
    """Rows of readers.task_directories: the texts of an exercise's files by their paths below it."""
    examples = F.map_filter(as_map(), lambda k, _: F.startswith(k, F.lit(".meta/example.")))
    first = F.array_min(F.map_keys(examples))
    language, exercise = F.regexp_extract("file", r"([^/]+)/exercises/practice/[^/]+$", 1), name()
    return open_qa(
        text(".docs/instructions.md"), null_empty(F.try_element_at(examples, first)), task_type=F.lit("code_generation"), orig_id=F.concat_ws("/", language, exercise),
        metadata=meta(language=language, exercise=exercise, example_file=null_empty(F.regexp_extract(first, r"([^/]+)$", 1)), config=F.try_parse_json(get(".meta/config.json"))), reject={"aider_empty_instructions": text(".docs/instructions.md") == ""},
    ) | {"source_file": F.concat("file", F.lit("/.docs/instructions.md"))}


# --- instructions, law, science, preferences -----------------------------------------------------


@dataset("ifeval-data", "instruction")
def _ifeval():
    return open_qa(text("prompt", "text"), F.lit(""), task_type=F.lit("instruction_following"), orig_id=text("key"), metadata=rest("prompt", "text", "key"), reject={"missing_prompt_or_key": (strip(text("prompt", "text")) == "") | (text("key") == "")})


def _with_tasks(raw: DataFrame, tasks: DataFrame) -> DataFrame:
    """tasks: task, task_row (VARIANT: instruction, answer_space, eval_method)."""
    return raw.withColumn("__task", folder()).join(tasks.select("task", F.col("task_row").alias("side")), F.col("__task") == F.col("task"), "left")


@dataset("legalbench", "instruction", _with_tasks)
def _legalbench():
    low = F.transform_values(F.transform_keys(as_map(), lambda k, _: F.lower(k)), lambda _, v: strip(v))
    instruction = null_empty(get("instruction", of="side"))
    space = F.coalesce(get("answer_space", "array<string>", of="side"), F.array().cast("array<string>"))
    chosen = F.array_sort(F.transform(F.filter(F.map_keys(low), lambda k: F.rlike(k, F.lit(r"^choice_\d+$"))), lambda k: F.struct(F.regexp_extract(k, r"(\d+)$", 1).cast("int").alias("n"), k.alias("k"))))
    own = F.transform(chosen, lambda k: F.element_at(low, k["k"]))
    answer = null_empty(F.try_element_at(low, F.lit("answer")))
    question = F.when(F.rlike(instruction, F.lit(r"\{\{\w+\}\}")), P.template(instruction, low)).otherwise(null_empty(F.try_element_at(low, F.lit("text"))))
    mcq = (F.size(space) >= 2) | (F.size(own) >= 2)
    options = F.when(mcq & (F.size(own) == 0) & (F.size(space) >= 2), space).otherwise(own)
    numbered = (F.size(options) > 0) & F.rlike(answer, F.lit(r"^\d+$")) & (answer.try_cast("int") < F.size(options))
    alike = F.try_element_at(F.filter(space, lambda s: F.lower(s) == F.lower(answer)), F.lit(1))
    label = F.when((F.size(options) == 0) & ~F.array_contains(space, answer), F.coalesce(F.nullif(alike, F.lit("")), answer)).otherwise(answer)
    return {
        "task_type": F.when(mcq, "mcq").otherwise("open_qa"), "lang": F.lit("en"), "split": stem(), "question": question, "options": F.when(mcq, options), "orig_id": text("index"),
        "answer": F.when(numbered, F.try_element_at(options, answer.try_cast("int") + 1)).otherwise(label),
        "metadata": meta(task_name=folder(), eval_method=null_empty(get("eval_method", of="side")), answer_space=space, answer_index=F.when(numbered, answer)),
        "reject": {"no_metadata": F.col("side").isNull(), "retired_file": ~stem().isin("train", "test"), "empty_text_or_missing_field": question == "", "empty_answer": answer == ""},
    }


def _contracts(raw: DataFrame) -> DataFrame:
    """One row a question of a contract's paragraphs: title, context and the question's place come as fields of it."""
    raw = raw.withColumns({"title": null_empty(get("title")), "nothing": F.when(F.col("row").isNotNull(), F.parse_json(F.lit("null")))}).withColumn("p", F.explode_outer(get("paragraphs", "array<variant>")))
    raw = raw.withColumn("context", null_empty(F.try_variant_get("p", "$.context", "string")))
    asked = raw.select(*[c for c in raw.columns if c not in ("row", "p", "at")], F.posexplode_outer(F.try_variant_get("p", "$.qas", "array<variant>")).alias("at", "row"))
    return asked.withColumn("row", F.coalesce("row", "nothing")).drop("nothing")  # JSON null where a readable contract has no question


@dataset("CUAD", "instruction", _contracts)
def _cuad():
    answers = F.coalesce(get("answers", "array<variant>"), F.array().cast("array<variant>"))
    texts = F.array_compact(F.transform(answers, lambda a: F.nullif(F.try_variant_get(a, "$.text", "string"), F.lit(""))))
    answer = F.array_join(texts, "\n")
    return {
        "task_type": F.lit("long_context"), "lang": F.lit("en"), "split": F.lit("test"), "question": text("question"), "answer": answer, "orig_id": F.concat("title", F.lit("#"), F.col("at").cast("string")),
        "metadata": meta(contract_title=F.col("title"), clause_type=F.regexp_extract(text("question"), '"(.+?)"', 1), context_chars=F.length("context"), context=F.col("context")),
        "reject": {"no_questions": F.is_variant_null("row"), "no_highlight_answer": F.size(answers) == 0, "blank_highlight": strip(answer) == ""},
    }


def _with_worlds(raw: DataFrame, worlds: DataFrame) -> DataFrame:
    """worlds: world_row (VARIANT)."""
    keyed = worlds.select(get("world_id", of="world_row").alias("__world"), F.col("world_row").alias("side"))
    return raw.join(keyed, get("world_id") == F.col("__world"), "left")


@dataset("apex-agents", "instruction", _with_worlds)
def _apex_agents():
    apps = F.coalesce(F.try_variant_get("side", "$.apps", "array<variant>"), F.array().cast("array<variant>"))
    names = F.array_compact(F.transform(apps, lambda a: F.nullif(F.try_variant_get(a, "$.service_name", "string"), F.lit(""))))
    side = lambda n: null_empty(get(n, of="side"))
    kept = ("task_name", "domain", "world_id", "task_input_files", "expected_output", "gold_response_type", "rubric")
    return {
        "task_type": F.lit("instruction_following"), "lang": F.lit("en"), "question": text("prompt"), "answer": text("gold_response"), "orig_id": text("task_id"),
        "metadata": meta(*kept, world_name=side("world_name"), world_description=side("world_description"), world_apps=names, num_rubric_criteria=F.coalesce(F.size(get("rubric", "array<variant>")), F.lit(0))),
        "reject": {"empty_prompt": text("prompt") == "", "empty_gold_response": text("gold_response") == "", "world_not_found": F.col("side").isNull()},
    }


def _examples(raw: DataFrame) -> DataFrame:
    return raw.withColumn("ex", F.explode_outer(get("examples", "array<variant>")))


@dataset("chembench", "math", _examples)
def _chembench():
    scores = F.from_json(get("target_scores", of="ex"), "map<string,double>")
    scored = F.coalesce(F.size(scores) > 0, F.lit(False))
    right = F.map_keys(F.map_filter(scores, lambda _, v: v == 1))
    question, target = null_empty(get("input", of="ex")), get("target", of="ex")
    return {
        "task_type": F.when(scored, "mcq").otherwise("open_qa"), "lang": F.lit("en"), "question": question, "options": F.when(scored, F.map_keys(scores)), "orig_id": text("uuid"),
        "answer": F.when(scored, null_empty(F.try_element_at(right, F.lit(1)))).otherwise(target), "metadata": meta("name", "keywords", subfield=folder()),
        "reject": {"no_examples": F.col("ex").isNull(), "chembench_empty_input": question == "", "chembench_no_answer": ~scored & target.isNull()},
    }


@dataset("scivqr", "math")
def _scivqr():
    names = ("question_type", "level", "subject")
    return open_qa(
        text("question"), text("answer"), task_type=F.lit("mcq"), options=items("choices"), solution=text("solution"), orig_id=text("pid"),
        metadata=meta(*names, sub_subject=get("sub-subject"), has_image=get("decoded_image", "variant").isNotNull() & ~F.is_variant_null(get("decoded_image", "variant"))),
        reject={"scivqr_empty_question": text("question") == "", "scivqr_no_choice_answer": (F.size(items("choices")) == 0) & (text("answer") == "")},
    )


@dataset("formalmath", "math")
def _formalmath():
    return open_qa(text("refined_statement"), text("autoformalization"), orig_id=text("theorem_names"), metadata=meta("source", "theorem_names", "compiler_feedback_bool", "compiler_feedback"), reject={"formalmath_empty_statement": text("refined_statement") == ""})


def _without_notes(raw: DataFrame) -> DataFrame:
    """Rows whose only field is 'information' are notes about the file, not questions."""
    return raw.where(F.coalesce(F.array_join(F.map_keys(as_map()), ",") != "information", F.lit(True)))


@dataset("hipho", "math", _without_notes)
def _hipho():
    context, q = strip(get("context")), strip(get("question"))
    question = F.when(context == "", q).otherwise(strip(F.concat(context, F.lit("\n"), q)))
    return open_qa(question, null_empty(F.try_element_at(P.leaves(get("answer")), F.lit(1))), "hipho_empty_question", solution=F.array_join(P.leaves(get("marking")), "\n"), orig_id=text("id"), metadata=meta("answer_type", "unit", "points", "modality", "field", "source", "image_question"))


@dataset("physics-data", "math")
def _physics():
    return open_qa(text("question"), null_empty(F.try_element_at(P.leaves(get("answer")), F.lit(1))), solution=text("solution"), orig_id=text("id"), metadata=meta("answer_type", "domain", "difficulty", "translate"), reject={"physics_empty_question": text("question") == ""}) | {"lang": F.coalesce(F.nullif(get("language"), F.lit("")), F.lit("zh"))}


@dataset("ruler", "instruction")
def _ruler():
    answer = F.when(is_list("answer"), F.array_join(items("answer"), ", ")).otherwise(text("answer"))
    return open_qa(text("question"), answer, task_type=F.lit("long_context"), metadata=meta("task", "context", "answer_prefix", "max_new_tokens", context_length=folder(), context_len_chars=F.length(text("context"))), reject={"ruler_empty_question": text("question") == ""})


@dataset("bfcl", "instruction")
def _bfcl():
    plain = F.schema_of_variant(get("question", "variant")) == "STRING"
    nested = F.coalesce(F.try_variant_get("row", "$.question[0][0].content", "string"), F.try_variant_get("row", "$.question[0].content", "string"))
    content = null_empty(F.when(plain, get("question")).otherwise(nested))
    answer = F.when(is_list("ground_truth"), F.array_join(items("ground_truth"), "\n")).otherwise(text("ground_truth"))
    return open_qa(content, answer, task_type=F.lit("instruction_following"), orig_id=text("id"), metadata=meta("execution_result_type", file=name(), functions=get("function", "variant")), reject={"bfcl_bad_question": content == ""})


def _task_folder(answer: str, reason: str, **values: str) -> dict[str, Column]:
    """Rows of readers.task_directories: instruction.md, an answer file and task.toml."""
    toml = P.toml_json(get("task.toml"))
    return open_qa(text("instruction.md"), text(answer), task_type=F.lit("instruction_following"), orig_id=name(), metadata=meta(**{k: F.get_json_object(toml, path) for k, path in values.items()}), reject={reason: text("instruction.md") == ""}) | {"source_file": F.concat("file", F.lit("/instruction.md"))}


@dataset("apex-accounting", "instruction")
def _accounting():
    return _task_folder("solution/answer.txt", "accounting_empty_instruction", name="$.task.name", description="$.task.description", domain="$.metadata.domain", expected_output="$.metadata.expected_output")


@dataset("terminal-bench", "instruction")
def _terminal():
    return _task_folder("solution/solve.sh", "terminal_empty_instruction", name="$.task.name", category="$.metadata.category", subcategory="$.metadata.subcategory", tags="$.metadata.tags")


@dataset("apex-v1-extended", "instruction")
def _apex_v1():
    rubric = F.when(text("Rubric JSON") == "", F.parse_json(F.lit("{}"))).otherwise(F.coalesce(F.try_parse_json(get("Rubric JSON")), F.to_variant_object(F.struct(get("Rubric JSON").alias("raw")))))
    attachments = F.array_remove(F.split(text("File Attachments"), r"\r?\n"), "")
    return open_qa(text("Prompt"), F.lit(""), task_type=F.lit("instruction_following"), orig_id=text("Task ID"), metadata=meta(domain=text("Domain"), rubric=rubric, attachments=attachments), reject={"apexv1_empty_prompt": text("Prompt") == ""})


@dataset("prbench", "instruction")
def _prbench():
    turns, wide = F.coalesce(get("turns").try_cast("int"), F.lit(0)), as_map()
    at = F.when(turns > 0, F.sequence(F.lit(0), turns - 1)).otherwise(F.array().cast("array<int>"))
    side = lambda name, k: F.try_element_at(wide, F.concat(F.lit(f"{name}_"), k.cast("string")))
    said = F.filter(F.transform(at, lambda k: F.struct(k.alias("turn"), side("prompt", k).alias("prompt"), side("response", k).alias("response"))), lambda t: t["prompt"].isNotNull())
    return open_qa(text("prompt_0"), F.lit(""), orig_id=text("task"), metadata=meta("turns", "field", "topic", "decision_type", "rubric", dialogue=said), reject={"prbench_empty_prompt": text("prompt_0") == ""})


@dataset("criticleanbench", "instruction")
def _criticlean():
    question = null_empty(F.try_variant_get("row", "$.messages[0].content", "string"))
    return open_qa(question, F.lit(""), task_type=F.lit("instruction_following"), orig_id=text("id"), metadata=meta("tag", "source", "refined_statement", "autoformalization"), reject={"criti_empty_question": question == ""})


@dataset("arena-human-preference-55k", "instruction")
def _arena():
    side = lambda n: P.first_of_json_array(get(n))
    winner = F.when(get("winner_model_a") == "1", "a").when(get("winner_model_b") == "1", "b").otherwise("tie")
    answer = F.when(winner == "a", side("response_a")).when(winner == "b", side("response_b")).otherwise("")
    return open_qa(side("prompt"), answer, orig_id=text("id"), metadata=meta("model_a", "model_b", winner=winner, response_a=side("response_a"), response_b=side("response_b")), reject={"arena_empty_prompt": side("prompt") == ""})


@dataset("sciarena-literature", "instruction")
def _sciarena():
    vote = F.lower(strip(get("vote")))
    answer = F.when(vote.isin("a", "modela"), text("responseA")).when(vote.isin("b", "modelb"), text("responseB")).otherwise("")
    return open_qa(text("question"), answer, orig_id=text("id"), metadata=meta("citations_a", "citations_b", "question_type", "subject", vote=vote, model_a=text("modelA"), model_b=text("modelB"), response_a=text("responseA"), response_b=text("responseB")), reject={"sciarena_empty_question": text("question") == ""})


@dataset("financebench", "instruction")
def _finance():
    names = ("company", "doc_name", "question_type", "question_reasoning", "domain_question_num", "evidence", "gics_sector", "doc_type", "doc_period", "dataset_subset_label")
    return open_qa(text("question"), text("answer"), solution=text("justification"), orig_id=text("financebench_id"), metadata=meta(*names), reject={"finance_empty_question": text("question") == ""})

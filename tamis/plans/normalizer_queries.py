"""One query a dataset: its raw rows are made of the parts table, normalised, and held against records written in SQL.

A case gives the file of a raw row and its fields as SQL that Spark and DuckDB read alike, and the record expected
of it. All columns of a record are compared for good rows, the reason alone for rejects.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.operators import normalizers

COLUMNS = ("task_type", "lang", "split", "question", "answer", "options", "solution", "source_file", "orig_id", "m")
K, S = "p_partkey", "cast(p_partkey as string)"
ASK = f"case when {K} % 7 = 0 then '' else 'How many ' || p_name || '?' end"
BLANK = f"{K} % 7 = 0"
UNREADABLE = f"{K} % 97 = 0"  # rows that are no JSON


@dataclass(frozen=True)
class Case:
    file: str  # SQL of the path
    fields: dict[str, str]  # field -> Spark SQL
    expected: dict[str, str]  # column -> DuckDB SQL; others are empty
    reject: str = "cast(null as varchar)"  # DuckDB SQL of the reason
    metas: tuple[str, ...] = ()  # JSON paths of metadata, joined by '~' in column m
    sides: Callable[[SparkSession, DataFrame], dict[str, DataFrame]] | None = None
    extra: dict[str, str] = field(default_factory=dict)  # further raw columns, Spark SQL


CASES: dict[str, Case] = {}


def case(name: str, file: str, fields: dict[str, str], expected: dict[str, str], reject: str | None = None, metas=(), sides=None, **extra: str) -> None:
    when = "cast(null as varchar)" if reject is None else reject if reject.startswith("case") else f"case when {BLANK} then '{reject}' end"
    CASES[name] = Case(file, fields, {"task_type": "'open_qa'", "lang": "'en'", "source_file": file} | expected, when, tuple(metas), sides, extra)


def run(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    c = CASES[name]
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    # Narrow rows make costly records: a file, or a row group, of a million of them must not be one task.
    dealt = parts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), K)
    row = ", ".join(f"'{k}', {v}" for k, v in c.fields.items())
    raw = dealt.selectExpr(f"{K} as rid", f"{c.file} as file", f"case when not ({UNREADABLE}) then parse_json(to_json(named_struct({row}))) end as row", *[f"{v} as {k}" for k, v in c.extra.items()])
    out = normalizers.normalize(raw, name, **(c.sides(spark, parts) if c.sides else {}))
    m = F.concat_ws("~", *[F.coalesce(F.get_json_object("metadata", path), F.lit("")) for path in c.metas])
    out = out.withColumns({"options": F.array_join("options", "|"), "m": m})
    good = F.col("reject_reason").isNull()
    return out.select("rid", "dataset", "category", *[F.when(good, F.col(x)).otherwise("").alias(x) for x in COLUMNS], "reject_reason")


def sql(name: str) -> str:
    c, d = CASES[name], normalizers.REGISTRY[name]
    values = ", ".join(f"case when reason is null then coalesce(cast(({c.expected.get(x, chr(39) * 2)}) as varchar), '') else '' end as {x}" for x in COLUMNS)
    return f"select {K} as rid, '{d.name}' as dataset, '{d.category}' as category, {values}, reason as reject_reason from (select *, case when {UNREADABLE} then 'json_parse_error' else {c.reject} end as reason from part)"


PLAIN = {"question": ASK, "answer": S}
QA = {"question": ASK, "answer": S}
ABCD = {"A": "p_brand", "B": "p_type", "C": "p_name", "D": "'none'"}
LETTER = f"case {K} % 5 when 0 then 'A' when 1 then ' B ' when 2 then 'C' when 3 then 'D' else 'X' end"
CHOSEN = f"case {K} % 5 when 0 then p_brand when 1 then p_type when 2 then p_name when 3 then 'none' else '' end"
TRIMMED = f"trim({LETTER})"
MCQ = {"task_type": "'mcq'", "lang": "'zh'", "question": ASK, "answer": CHOSEN, "options": "p_brand || '|' || p_type || '|' || p_name || '|none'"}

# Mathematics.
case("gsm8k", f"case when {K} % 2 = 0 then 'gsm8k/main/train-00000-of-00001.parquet' else 'gsm8k/main/test-00000-of-00001.parquet' end",
     {"question": ASK, "answer": f"case when {K} % 3 = 0 then ' ' || {S} else p_name || ' <<1+1=2>> ' || chr(10) || '#### ' || {S} || ' ' end"},
     {"split": f"case when {K} % 2 = 0 then 'train' else 'test' end", "question": ASK, "answer": S, "solution": f"case when {K} % 3 = 0 then '' else p_name || ' <<1+1=2>>' end"}, "empty_question")
case("PolyMath", f"'PolyMath/' || case when {K} % 2 = 0 then 'de' else 'sw' end || '/high.parquet'", PLAIN | {"id": f"'p' || {S}"},
     QA | {"lang": f"case when {K} % 2 = 0 then 'de' else 'sw' end", "orig_id": f"'p' || {S}", "m": "'high'"}, "empty_question", ["$.level"])
case("aqua_rat", "'aqua_rat/raw/validation-00000-of-00001.parquet'",
     {"question": ASK, "options": "array('A)' || p_brand, 'B) ' || p_type, 'C)' || p_name)", "correct": f"case {K} % 4 when 0 then 'A' when 1 then 'B' when 2 then 'C' else 'E' end", "rationale": "p_name"},
     {"task_type": "'mcq'", "split": "'validation'", "question": ASK, "options": "p_brand || '|' || p_type || '|' || p_name", "answer": f"case {K} % 4 when 0 then p_brand when 1 then p_type else p_name end", "solution": "p_name", "m": f"case {K} % 4 when 0 then 'A' when 1 then 'B' else 'C' end"},
     f"case when {BLANK} then 'empty_question' when {K} % 4 = 3 then 'answer_letter_not_in_options' end", ["$.answer_letter"])
case("ChilleD_SVAMP", "'ChilleD_SVAMP/data/test-00000-of-00001.parquet'", {"Body": f"case {K} % 3 when 0 then p_name || '.' when 1 then p_name else '' end", "Question": ASK, "Answer": "p_size", "Equation": "'( 1 + 2 )'", "ID": S, "Type": "p_type"},
     {"split": "'test'", "question": f"case when {BLANK} then case {K} % 3 when 0 then p_name || '.' when 1 then p_name end else case {K} % 3 when 0 then p_name || '. ' when 1 then p_name || '. ' else '' end || {ASK} end", "answer": "p_size", "solution": "'( 1 + 2 )'", "orig_id": S, "m": "p_type"},
     f"case when {BLANK} and {K} % 3 = 2 then 'empty_question' end", ["$.Type"])
case("MultiArith", "'MultiArith/train.json'", {"question": f"case when {K} % 2 = 0 then {ASK} end", "Body": "p_name", "Question": "p_brand", "final_ans": S}, {"split": "'train'", "question": f"case when {K} % 2 = 0 and not {BLANK} then {ASK} else p_name || ' ' || p_brand end", "answer": S})
case("math", "'math/dataset/MATH.parquet'", {"problem": ASK, "solution": f"case {K} % 4 when 0 then 'so \\\\boxed{{1}} and \\\\boxed{{a{{' || {S} || '}}b}} end' when 1 then 'so \\\\boxed ' || {S} || '.' when 2 then 'open \\\\boxed{{x' else 'none' end", "level": "'Level 5'"},
     {"question": ASK, "answer": f"case {K} % 4 when 0 then 'a{{' || {S} || '}}b' when 1 then {S} else '' end", "solution": f"case {K} % 4 when 0 then 'so \\boxed{{1}} and \\boxed{{a{{' || {S} || '}}b}} end' when 1 then 'so \\boxed ' || {S} || '.' when 2 then 'open \\boxed{{x' else 'none' end", "m": "'Level 5'"}, "empty_problem", ["$.level"])
case("mmath", "'MMATH/mmath/ko.json'", PLAIN | {"gid": f"case when {K} % 2 = 0 then {S} end", "subject": "p_type"}, QA | {"lang": "'ko'", "orig_id": f"case when {K} % 2 = 0 then {S} else cast(p_size as string) end", "m": "p_type"}, "empty_question", ["$.subject"], at="cast(p_size as bigint)")
case("mathqa", "'MathQA/challenge_test.json'", {"Problem": ASK, "options": f"case when {K} % 5 = 0 then '' else 'a ) ' || p_brand || ' , b ) b ) ' || {S} || ' , c ) none' end", "correct": f"case when {K} % 2 = 0 then 'a' else 'B' end", "Rationale": "p_name", "category": "'gain'"},
     {"task_type": "'mcq'", "split": "'challenge_test'", "question": ASK, "options": f"p_brand || '|' || {S} || '|none'", "answer": f"case when {K} % 2 = 0 then p_brand else {S} end", "solution": "p_name", "m": f"'gain~' || case when {K} % 2 = 0 then 'a' else 'b' end"},
     f"case when {BLANK} then 'empty_problem' when {K} % 5 = 0 then 'no_options' end", ["$.category", "$.answer_letter"])
case("apple_gsm_symbolic", "'apple_GSM-Symbolic/p1/test.jsonl'", PLAIN | {"id": K, "instance": "p_size"}, QA | {"split": "'test'", "orig_id": S, "m": "'p1~' || p_size"}, "empty_question", ["$.variant", "$.instance"])
case("gsm_plus", "'GSM-Plus/data/testmini-00000-of-00001.jsonl'", PLAIN | {"solution": "p_name", "perturbation_type": "p_type"}, QA | {"split": "'testmini'", "solution": "p_name", "m": "p_type"}, "empty_question", ["$.perturbation_type"])
case("asdiv", "'asdiv/ASDiv.xml'", {"Body": "' ' || p_name || ' '", "Question": ASK, "Answer": f"{S} || ' '", "Formula": "p_type"}, {"question": f"trim(p_name || ' ' || {ASK})", "answer": S, "orig_id": "p_size", "m": "p_type"}, None, ["$.Formula"], at="cast(p_size as bigint)")
case("mathmist", f"'MathMist/Data/' || case when {K} % 11 = 0 then 'Evaluation Results' else 'mcq/en' end || '/x.jsonl'",
     {"Question": ASK, "Language": "case when p_size % 2 = 0 then 'Bengali' else 'Lithuanian ' end", "Multiple Choices": f"case {K} % 3 when 0 then '[\"A. ' || p_brand || '\", \"B) ' || p_type || '\"]' when 1 then 'A. ' || p_brand || ', B. ' || p_type else '' end", "Correct Answer": f"case when {K} % 2 = 0 then 'b' else 'Z' end", "Exact Answer": "p_name", "Solution": "p_brand"},
     {"task_type": f"case when {K} % 3 < 2 then 'mcq' else 'open_qa' end", "lang": "case when p_size % 2 = 0 then 'bn' else 'lt' end", "question": ASK, "options": f"case when {K} % 3 < 2 then p_brand || '|' || p_type end", "answer": f"case when {K} % 3 < 2 and {K} % 2 = 0 then p_type else p_name end", "solution": "p_brand", "m": f"case when {K} % 3 < 2 then case when {K} % 2 = 0 then 'B' else 'Z' end else '' end || '~mcq/en'"},
     f"case when {K} % 11 = 0 then 'skipped_model_output_dir' when {BLANK} then 'empty_question' end", ["$.answer_letter", "$.file_subdir"])
for _ds in ("aime-2025", "aime-2026"):
    case(_ds, f"'{_ds}/data/train-00000-of-00001.parquet'", {"problem": "p_name", "answer": K, "problem_idx": "p_size", "problem_type": "array(p_type)"}, {"split": "'test'", "question": "p_name", "answer": S, "orig_id": "p_size", "m": "'[\"' || p_type || '\"]'"}, f"case when {K} < 0 then 'empty_question' end", ["$.problem_type"])
case("gsm1k", "'gsm1k/data/test/data-00000-of-00001.arrow'", {"question": "p_name", "answer": K}, {"split": "'test'", "question": "p_name", "answer": S, "orig_id": S}, at=f"cast({K} as bigint)")

# Chinese benchmarks.
case("ceval-data", "'ceval-data/law/val-00000-of-00001.parquet'", {"id": K, "question": ASK, "answer": LETTER, "explanation": "p_name"} | ABCD, MCQ | {"split": "'val'", "solution": "p_name", "orig_id": S, "m": f"'law~' || {TRIMMED}"}, "ceval_empty_question", ["$.subject", "$.answer_letter"])
case("CMMLU", "'CMMLU/data/dev/anatomy.csv'", {"": K, "Question": ASK, "Answer": LETTER} | ABCD, MCQ | {"split": "'dev'", "orig_id": S, "m": f"'anatomy~' || {TRIMMED}"}, "cmmlu_empty_question", ["$.subject", "$.answer_letter"])
case("fineval", "'fineval/FinEval.zip!dev/tax_law_dev.csv'", {"id": K, "question": ASK, "answer": LETTER, "explanation": "p_name"} | {x: f"case when {K} % 3 = 0 then '' else {v} end" for x, v in ABCD.items()},
     MCQ | {"split": "'dev'", "solution": "p_name", "orig_id": S, "m": f"'tax_law~' || {TRIMMED}"}, f"case when {BLANK} then 'fineval_empty_question' when {K} % 3 = 0 then 'fineval_no_options' end", ["$.subject", "$.answer_letter"])
case("longbench-data", "'LongBench-data/data/gov_report_e.jsonl'", {"input": ASK, "answers": f"case when {K} % 2 = 0 then '[''' || p_brand || ''', ''' || p_type || ''']' else p_name end", "language": f"case {K} % 3 when 0 then 'zh' when 1 then 'en' else 'python' end", "_id": f"'i' || {S}", "context": "p_name"},
     {"task_type": "'long_context'", "lang": f"case {K} % 3 when 0 then 'zh' else 'en' end", "split": "'test'", "question": f"case when {BLANK} then '（长文本任务 gov_report_e）请根据给定上下文完成该任务，参考答案见 answer。' else {ASK} end", "answer": f"case when {K} % 2 = 0 then p_brand || chr(10) || p_type else p_name end", "orig_id": f"'i' || {S}", "m": f"'gov_report_e~' || case when {BLANK} then 'true' else 'false' end"}, None, ["$.subtask", "$.input_empty"])
case("GAOKAO-Bench", f"'GAOKAO-Bench/Data/' || case when {K} % 2 = 0 then 'Objective_Questions/2010-2022_Math_MCQs.json' else 'Subjective_Questions/2010-2022_English_Essay.json' end",
     {"question": f"case when {BLANK} then '' when {K} % 3 = 0 then p_name else p_name || ' （ ）' || chr(10) || 'A．' || p_brand || chr(10) || 'B. ' || p_type end", "answer": "array('A', 'B')", "analysis": "p_type", "year": "'2010'"},
     {"task_type": f"case when {K} % 2 = 0 and {K} % 3 > 0 then 'mcq' else 'open_qa' end", "lang": f"case when {K} % 2 = 0 then 'zh' else 'en' end", "split": "'test'",
      "question": f"case when {K} % 3 = 0 then p_name else p_name || ' （ ）' || case when {K} % 2 = 0 then '' else chr(10) || 'A．' || p_brand || chr(10) || 'B. ' || p_type end end",
      "answer": f"case when {K} % 2 = 0 and {K} % 3 > 0 then p_brand || ' ' || p_type else 'A B' end", "options": f"case when {K} % 2 = 0 and {K} % 3 > 0 then p_brand || '|' || p_type end", "solution": "p_type", "m": f"'2010~' || case when {K} % 2 = 0 then 'objective' else 'subjective' end"}, "gaokao_empty_question", ["$.year", "$.kind"])
case("AlignBench", "'AlignBench/data/data_v1.1_release.jsonl'", {"question": ASK, "reference": "p_name", "question_id": K, "category": "p_type"}, {"task_type": "'instruction_following'", "lang": "'zh'", "split": "'test'", "question": ASK, "answer": "p_name", "orig_id": S, "m": "p_type"}, "alignbench_empty_question", ["$.category"])
case("SafetyBench", f"'SafetyBench/opensource_data/test_' || case when {K} % 2 = 0 then 'zh' else 'en' end || '.json'", {"id": K, "question": ASK, "options": "array(p_brand, p_type, p_name)"},
     {"task_type": "'mcq'", "lang": f"case when {K} % 2 = 0 then 'zh' else 'en' end", "split": "'test'", "question": ASK, "options": "p_brand || '|' || p_type || '|' || p_name", "orig_id": S, "answer": f"case when {K} % 2 = 0 and p_size > 10 then case p_size % 4 when 0 then p_brand when 1 then p_type when 2 then p_name end end", "m": f"case when {K} % 2 = 0 and p_size > 10 then p_type else '' end"}, "safety_empty_question", ["$.category"],
     sides=lambda spark, parts: {"answers": parts.where("p_size > 10").selectExpr("'zh' as lang", f"{S} as id", "to_variant_object(named_struct('answer', p_size % 4, 'category', p_type)) as answer_row")})
case("ChineseSimpleQA", "'ChineseSimpleQA/data/chinese_simpleqa.jsonl'", {"问题": ASK, "答案": S, "来源": "p_brand"}, QA | {"lang": "'zh'", "split": "'test'", "m": "p_brand"}, "simpleqa_empty_question", ["$.来源"])
case("HalluQA", f"case when {K} % 2 = 0 then 'HalluQA/HalluQA.json' else 'HalluQA/HalluQA_mc.json' end",
     {"Question": ASK, "Best Answer1": "p_brand", "Best Answer2": "''", "Best Answer3": "p_type", "question_id": K, "answer": f"case when {K} % 3 = 0 then 'it is B' else 'A' end", "question": f"case when {BLANK} then '' when {K} % 5 = 1 then p_name else 'Question: ' || p_name || ' A: ' || p_brand || ' B：' || p_type end"},
     {"task_type": f"case when {K} % 2 = 1 and {K} % 5 <> 1 then 'mcq' else 'open_qa' end", "lang": "'zh'", "split": "'test'", "question": f"case when {K} % 2 = 0 then {ASK} else p_name end", "orig_id": f"case when {K} % 2 = 1 then {S} end",
      "answer": f"case when {K} % 2 = 0 then p_brand || chr(10) || p_type when {K} % 5 = 1 then case when {K} % 3 = 0 then 'it is B' else 'A' end when {K} % 3 = 0 then p_type else p_brand end", "options": f"case when {K} % 2 = 1 and {K} % 5 <> 1 then p_brand || '|' || p_type end", "m": f"case when {K} % 2 = 0 then 'open' else 'mc' end"},
     f"case when {BLANK} then case when {K} % 2 = 0 then 'hallu_open_empty_question' else 'hallu_mc_empty_question' end end", ["$.task"])
case("LawBench", f"case when {K} % 2 = 0 then 'LawBench/1-2/test.parquet' else 'LawBench/3-3/test.parquet' end", {"question": f"case when {BLANK} then ' ' else '正确?A:' || p_brand || ';B:' || p_type || ';' end", "answer": f"case when {K} % 5 = 0 then '' when {K} % 3 = 0 then p_name else '正确答案：B。' end", "instruction": "p_name"},
     {"task_type": f"case when {K} % 3 = 0 then 'open_qa' else 'mcq' end", "lang": "'zh'", "split": "'test'", "question": "'正确?A:' || p_brand || ';B:' || p_type || ';'", "answer": f"case when {K} % 3 = 0 then p_name else p_type || ';' end", "options": f"case when {K} % 3 > 0 then p_brand || ';|' || p_type || ';' end", "m": f"case when {K} % 2 = 0 then '法律知识问答' else '罪名预测' end || '~' || case when {K} % 3 = 0 then '' else 'B' end"},
     f"case when {BLANK} then 'empty_question' when {K} % 5 = 0 then 'empty_answer' end", ["$.task_name", "$.answer_letter"])

# Code.
case("swe-bench-data", "'SWE-bench-data/data/dev-00000-of-00001.parquet'", {"problem_statement": ASK, "patch": "p_name", "instance_id": f"case when {K} % 10 = 1 then '' else 'r-' || {S} end", "repo": "p_brand", "FAIL_TO_PASS": "'[\"' || p_type || '\"]'", "PASS_TO_PASS": "p_type"},
     {"task_type": "'swe'", "lang": "''", "split": "'dev'", "question": ASK, "answer": "p_name", "orig_id": f"'r-' || {S}", "m": "p_brand || '~' || p_type || '~' || p_type"}, f"case when {BLANK} or {K} % 10 = 1 then 'missing_problem_statement_or_instance_id' end", ["$.repo", "$.FAIL_TO_PASS[0]", "$.PASS_TO_PASS"])
case("livecodebench-data", "'LiveCodeBench-data/test.jsonl'", {"question_content": ASK, "question_id": S, "code": "''", "solution": "p_name", "public_test_cases": f"'[{{\"input\": ' || {S} || '}}]'", "difficulty": "'easy'"}, {"task_type": "'code_generation'", "lang": "''", "split": "'test'", "question": ASK, "answer": "p_name", "orig_id": S, "m": f"'easy~' || {S}"}, "missing_question_content_or_id", ["$.difficulty", "$.public_test_cases[0].input"])
case("scicode", f"case when {K} % 2 = 0 then 'scicode/problems_test.jsonl' else 'scicode/problems_dev.jsonl' end", {"problem_description_main": ASK, "problem_id": K, "sub_steps": f"array(named_struct('function_header', 'def a' || {S} || '():'), named_struct('function_header', ''), named_struct('function_header', 'def b():'))", "problem_name": "p_name"},
     {"task_type": "'code_generation'", "split": f"case when {K} % 2 = 0 then 'test' else 'dev' end", "question": ASK, "answer": f"'def a' || {S} || '():' || chr(10) || chr(10) || 'def b():'", "orig_id": S, "m": "p_name"}, "scicode_empty_description", ["$.problem_name"])
case("aider-polyglot", f"'aider-polyglot/go/exercises/practice/e' || {S}", {".docs/instructions.md": ASK, ".meta/example.go": "p_name", ".meta/config.json": "'{\"blurb\": \"' || p_brand || '\"}'"},
     {"task_type": "'code_generation'", "question": ASK, "answer": "p_name", "orig_id": f"'go/e' || {S}", "source_file": f"'aider-polyglot/go/exercises/practice/e' || {S} || '/.docs/instructions.md'", "m": "'go~example.go~' || p_brand"}, "aider_empty_instructions", ["$.language", "$.example_file", "$.config.blurb"])

# Instructions, law, science, preferences.
FOLLOW = {"task_type": "'instruction_following'"}
case("ifeval-data", "'IFEval-data/ifeval_input_data.jsonl'", {"prompt": ASK, "key": K, "instruction_id_list": "array(p_type)"}, FOLLOW | {"question": ASK, "orig_id": S, "m": "p_type"}, "missing_prompt_or_key", ["$.instruction_id_list[0]"])
case("legalbench", f"'legalbench/data/' || case {K} % 4 when 0 then 'hearsay' when 1 then 'scalr' when 2 then 'free' else 'unknown' end || '/' || case when {K} % 13 = 0 then 'test_old' else 'test' end || '.tsv'",
     {"index": K, "Text": ASK, "answer": f"case when {K} % 4 = 1 then '1' when p_size % 6 = 0 then ' ' else 'YES' end", "choice_0": f"case when {K} % 4 = 1 then p_brand end", "choice_1": f"case when {K} % 4 = 1 then p_type end"},
     {"task_type": f"case {K} % 4 when 2 then 'open_qa' else 'mcq' end", "split": "'test'", "question": f"case {K} % 4 when 0 then 'Is this hearsay? ' || {ASK} else {ASK} end", "answer": f"case {K} % 4 when 0 then 'YES' when 1 then p_type else 'Yes' end",
      "options": f"case {K} % 4 when 0 then 'Yes|No' when 1 then p_brand || '|' || p_type end", "orig_id": S, "m": f"case {K} % 4 when 0 then 'hearsay' when 1 then 'scalr' else 'free' end || '~' || case when {K} % 4 = 1 then '1' else '' end"},
     f"case when {K} % 4 = 3 then 'no_metadata' when {K} % 13 = 0 then 'retired_file' when {BLANK} then 'empty_text_or_missing_field' when {K} % 4 <> 1 and p_size % 6 = 0 then 'empty_answer' end", ["$.task_name", "$.answer_index"],
     sides=lambda spark, parts: {"tasks": spark.sql("select task, to_variant_object(named_struct('instruction', instruction, 'answer_space', space, 'eval_method', 'em')) as task_row from values ('hearsay', 'Is this hearsay? {{text}}', array('Yes', 'No')), ('scalr', '', array()), ('free', 'no place', array('Yes')) as t(task, instruction, space)")})
case("CUAD", "'CUAD/CUAD_v1/CUAD_v1.json'", {"title": f"'c' || {S}", "paragraphs": "filter(array(named_struct('context', p_name, 'qas', filter(array(named_struct('question', 'Highlight \"' || p_type || '\" here', 'answers', case p_size % 3 when 0 then array(named_struct('text', p_brand), named_struct('text', p_name)) when 1 then array(named_struct('text', ' ')) else array() end)), x -> p_size % 11 <> 0))), x -> p_size % 13 <> 0)"},
     {"task_type": "'long_context'", "split": "'test'", "question": "'Highlight \"' || p_type || '\" here'", "answer": "p_brand || chr(10) || p_name", "orig_id": f"'c' || {S} || '#0'", "m": "p_type || '~' || length(p_name)"}, "case when p_size % 11 = 0 or p_size % 13 = 0 then 'no_questions' when p_size % 3 = 2 then 'no_highlight_answer' when p_size % 3 = 1 then 'blank_highlight' end", ["$.clause_type", "$.context_chars"])
case("apex-agents", "'apex-agents/tasks_and_rubrics.json'", {"task_id": S, "prompt": ASK, "gold_response": "case when p_size = 1 then '' else p_name end", "world_id": "p_brand", "rubric": "array(named_struct('criteria', p_type))"},
     FOLLOW | {"question": ASK, "answer": "p_name", "orig_id": S, "m": "'World of ' || p_brand || '~mail~1'"}, f"case when {BLANK} then 'empty_prompt' when p_size = 1 then 'empty_gold_response' when p_brand = 'Brand#11' then 'world_not_found' end", ["$.world_name", "$.world_apps[0]", "$.num_rubric_criteria"],
     sides=lambda spark, parts: {"worlds": parts.select("p_brand").distinct().where("p_brand <> 'Brand#11'").selectExpr("to_variant_object(named_struct('world_id', p_brand, 'world_name', 'World of ' || p_brand, 'apps', array(named_struct('service_name', ''), named_struct('service_name', 'mail')))) as world_row")})
case("chembench", "'chembench/organic/train.parquet'", {"uuid": S, "name": "p_name", "examples": f"filter(array(named_struct('input', {ASK}, 'target', case when p_size % 3 = 1 then {S} end, 'target_scores', case when p_size % 3 = 0 then '{{\"' || p_type || '\": 0, \"' || p_brand || '\": 1}}' end)), x -> p_size % 11 <> 0)"},
     {"task_type": "case when p_size % 3 = 0 then 'mcq' else 'open_qa' end", "question": ASK, "options": "case when p_size % 3 = 0 then p_type || '|' || p_brand end", "answer": f"case when p_size % 3 = 0 then p_brand else {S} end", "orig_id": S, "m": "p_name || '~organic'"}, f"case when p_size % 11 = 0 then 'no_examples' when {BLANK} then 'chembench_empty_input' when p_size % 3 = 2 then 'chembench_no_answer' end", ["$.name", "$.subfield"])
case("scivqr", "'scivqr/data/train.parquet'", {"question": ASK, "choices": "case when p_size % 2 = 0 then array(p_brand, p_type) else array() end", "answer": "case when p_size % 3 = 0 then '' else p_type end", "pid": K, "solution": "p_name", "sub-subject": "p_brand", "decoded_image": "case when p_size % 5 = 0 then 'x' end"},
     {"task_type": "'mcq'", "question": ASK, "options": "case when p_size % 2 = 0 then p_brand || '|' || p_type end", "answer": "case when p_size % 3 > 0 then p_type end", "solution": "p_name", "orig_id": S, "m": "p_brand || '~' || case when p_size % 5 = 0 then 'true' else 'false' end"}, f"case when {BLANK} then 'scivqr_empty_question' when p_size % 6 = 3 then 'scivqr_no_choice_answer' end", ["$.sub_subject", "$.has_image"])
case("formalmath", "'formalmath/FormalMATH_all.json'", {"refined_statement": ASK, "autoformalization": "p_name", "theorem_names": f"'t' || {S}", "source": "p_type"}, {"question": ASK, "answer": "p_name", "orig_id": f"'t' || {S}", "m": "p_type"}, "formalmath_empty_statement", ["$.source"])
case("hipho", "'hipho/data/IPhO_2024.json'", {"id": K, "context": "case when p_size % 2 = 0 then p_name else '' end", "question": ASK, "answer": f"array(array({S}), array('x'))", "marking": "'[[''a ' || p_brand || '''], [''b'']]'", "unit": "'kg'"},
     {"question": f"trim(case when p_size % 2 = 0 then p_name || chr(10) else '' end || {ASK}, chr(10))", "answer": S, "solution": "'a ' || p_brand || chr(10) || 'b'", "orig_id": S, "m": "'kg'"}, f"case when {BLANK} and p_size % 2 = 1 then 'hipho_empty_question' end", ["$.unit"])
case("physics-data", "'physics-data/data/test.jsonl'", {"id": K, "question": ASK, "answer": f"case when p_size % 2 = 0 then '[''' || {S} || ''']' else {S} end", "language": "case when p_size % 3 = 0 then 'en' end", "solution": "p_name", "domain": "p_type"}, QA | {"lang": "case when p_size % 3 = 0 then 'en' else 'zh' end", "solution": "p_name", "orig_id": S, "m": "p_type"}, "physics_empty_question", ["$.domain"])
case("ruler", "'ruler/4096/data.parquet'", {"question": ASK, "context": "p_name", "answer": "array(p_brand, p_type)", "task": "'niah'"}, {"task_type": "'long_context'", "question": ASK, "answer": "p_brand || ', ' || p_type", "m": "'niah~4096~' || length(p_name)"}, "ruler_empty_question", ["$.task", "$.context_length", "$.context_len_chars"])
case("bfcl", "'bfcl/BFCL_v3_simple.json'", {"id": S, "question": f"array(array(named_struct('role', 'user', 'content', {ASK})))", "ground_truth": "array(p_brand, p_type)", "function": "array(p_name)"}, FOLLOW | {"question": ASK, "answer": "p_brand || chr(10) || p_type", "orig_id": S, "m": "'BFCL_v3_simple.json~' || p_name"}, "bfcl_bad_question", ["$.file", "$.functions[0]"])
case("apex-accounting", f"'apex-accounting/tasks/t' || {S}", {"instruction.md": ASK, "solution/answer.txt": "p_name", "task.toml": "'[task]' || chr(10) || 'name = \"' || p_brand || '\"' || chr(10) || '[metadata]' || chr(10) || 'domain = \"tax\"'"}, FOLLOW | {"question": ASK, "answer": "p_name", "orig_id": f"'t' || {S}", "source_file": f"'apex-accounting/tasks/t' || {S} || '/instruction.md'", "m": "p_brand || '~tax'"}, "accounting_empty_instruction", ["$.name", "$.domain"])
case("terminal-bench", f"'terminal-bench/tasks/t' || {S}", {"instruction.md": ASK, "solution/solve.sh": "p_name", "task.toml": "case when p_size % 2 = 0 then '[metadata]' || chr(10) || 'category = \"' || p_type || '\"' end"}, FOLLOW | {"question": ASK, "answer": "p_name", "orig_id": f"'t' || {S}", "source_file": f"'terminal-bench/tasks/t' || {S} || '/instruction.md'", "m": "case when p_size % 2 = 0 then p_type else '' end"}, "terminal_empty_instruction", ["$.category"])
case("apex-v1-extended", "'apex-v1-extended/data/train.csv'", {"Prompt": ASK, "Task ID": K, "Domain": "p_type", "Rubric JSON": "case when p_size % 2 = 0 then '{\"w\": ' || p_size || '}' else 'broken' end", "File Attachments": "p_brand || chr(10) || 'b.pdf'"}, FOLLOW | {"question": ASK, "orig_id": S, "m": "p_type || '~' || case when p_size % 2 = 0 then p_size || '~' else '~broken' end || '~b.pdf'"}, "apexv1_empty_prompt", ["$.domain", "$.rubric.w", "$.rubric.raw", "$.attachments[1]"])
case("prbench", "'prbench/data/legal.parquet'", {"task": S, "turns": "2", "prompt_0": ASK, "response_0": "p_name", "prompt_1": "p_type", "response_1": "case when p_size > 0 then p_brand end", "prompt_2": "'beyond'", "field": "'law'"}, {"question": ASK, "orig_id": S, "m": "'law~' || p_type || '~' || p_brand || '~'"}, "prbench_empty_prompt", ["$.field", "$.dialogue[1].prompt", "$.dialogue[1].response", "$.dialogue[2].prompt"])
case("criticleanbench", "'criticleanbench/test-00000-of-00001.parquet'", {"id": K, "messages": f"array(named_struct('role', 'user', 'content', {ASK}))", "tag": "p_type"}, FOLLOW | {"question": ASK, "orig_id": S, "m": "p_type"}, "criti_empty_question", ["$.tag"])
case("arena-human-preference-55k", "'arena-human-preference-55k/train.csv'", {"id": K, "prompt": f"'[\"' || {ASK} || '\", \"more\"]'", "response_a": "'[\"' || p_brand || '\"]'", "response_b": "p_type", "winner_model_a": "case when p_size % 3 = 0 then '1' else '0' end", "winner_model_b": "case when p_size % 3 = 1 then '1' else '0' end"},
     {"question": ASK, "answer": "case p_size % 3 when 0 then p_brand when 1 then p_type end", "orig_id": S, "m": "case p_size % 3 when 0 then 'a' when 1 then 'b' else 'tie' end || '~' || p_brand"}, "arena_empty_prompt", ["$.winner", "$.response_a"])
case("sciarena-literature", "'sciarena-literature/train.json'", {"id": S, "question": ASK, "vote": "case p_size % 3 when 0 then 'A' when 1 then 'modelB ' else 'tie' end", "responseA": "p_brand", "responseB": "p_type", "subject": "p_name"}, {"question": ASK, "answer": "case p_size % 3 when 0 then p_brand when 1 then p_type end", "orig_id": S, "m": "case p_size % 3 when 0 then 'a' when 1 then 'modelb' else 'tie' end || '~' || p_name"}, "sciarena_empty_question", ["$.vote", "$.subject"])
case("financebench", "'financebench/financebench_merged.jsonl'", {"financebench_id": S, "question": ASK, "answer": S, "justification": "p_name", "company": "p_brand"}, QA | {"solution": "p_name", "orig_id": S, "m": "p_brand"}, "finance_empty_question", ["$.company"])


def _query(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(spark, sf_dir, name)

    return query


QUERIES = {f"norm_{n.replace('-', '_').lower()}": _query(n) for n in CASES}
ORACLE_SQL = {f"norm_{n.replace('-', '_').lower()}": sql(n) for n in CASES}

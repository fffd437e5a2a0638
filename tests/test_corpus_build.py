"""A folder of collections in one run, and small operators."""

import csv
import io
import json
import zipfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tamis.functions import parsers, text
from tamis.operators import corpus, evalbuild, evalset, sessions, translation
from tamis.sources import writers


def test_all_forms_in_one_run(spark, tmp_path):
    folder = lambda n: (tmp_path / n).mkdir(parents=True) or tmp_path / n
    pq.write_table(pa.table({"question": ["q1", ""], "answer": ["w #### 1", "x"]}), folder("gsm8k/main") / "train-0.parquet")
    (folder("gsm_plus") / "data.jsonl").write_text('{"question": "q", "answer": "2", "solution": "s"}\nbroken\n\n')
    (folder("MultiArith") / "train.json").write_text(json.dumps([{"question": "q", "final_ans": "3"}]))
    text_ = io.StringIO()
    csv.writer(text_).writerows([["", "Question", "A", "B", "C", "D", "Answer"], ["0", "哪个?", "a", "b", "c", "d", "B"]])
    (folder("CMMLU/test") / "anatomy.csv").write_text(text_.getvalue(), encoding="utf-8-sig")
    with zipfile.ZipFile(folder("fineval") / "f.zip", "w") as z:
        z.writestr("dev/tax.csv", "id,question,A,B,C,D,answer,explanation\n0,哪?,a,b,c,d,A,e\n")
    (folder("asdiv") / "a.xml").write_text('<R><ProblemSet><Problem ID="n1"><Body>Two.</Body><Question>How many?</Question><Answer>2 (x)</Answer></Problem><Problem ID="n2"><Body>b</Body><Question>q</Question><Answer>3</Answer></Problem></ProblemSet></R>')
    with pa.OSFile(str(folder("gsm1k") / "s.arrow"), "wb") as f, pa.ipc.new_stream(f, pa.schema([("question", pa.string()), ("answer", pa.string())])) as w:
        w.write_batch(pa.record_batch([pa.array(["q"]), pa.array(["4"])], names=["question", "answer"]))
    task = folder("terminal-bench/t1")
    (task / "instruction.md").write_text("do it")
    (task / "task.toml").write_text('[metadata]\ndifficulty = "hard"\n')
    (task / "solution").mkdir()
    (task / "solution" / "solve.sh").write_text("ls")
    folder("unknown-one")
    folder(".hidden")
    out, unknown = corpus.build(spark, str(tmp_path))
    assert unknown == ["unknown-one"]
    counts = {(r["dataset"], r["reason"]): r["n"] for r in corpus.report(out).collect()}
    names = {d for d, _ in counts} - {""}
    assert names == {"gsm8k", "gsm_plus", "MultiArith", "CMMLU", "fineval", "asdiv", "gsm1k", "terminal-bench"}
    assert counts["gsm_plus", "json_parse_error"] == 1 and counts["gsm_plus", ""] == 1 and counts["asdiv", ""] == 2
    assert counts["", ""] == sum(n for (d, r), n in counts.items() if d and not r) and sum(counts.values()) == 2 * out.count()
    seen = {r["dataset"]: r for r in corpus.samples(out, ["source_file", "question"]).collect()}
    assert seen["asdiv"]["empty_answers"] == 0 and len(seen["asdiv"]["samples"]) == 2 and seen["CMMLU"]["samples"][0]["question"] == "哪个?"
    only, _ = corpus.build(spark, str(tmp_path), only=["GSM_PLUS"])
    assert {r["dataset"] for r in only.collect()} == {"gsm_plus"}
    assert set(corpus.FORM_OF) == set(__import__("tamis.operators.normalizers", fromlist=["x"]).REGISTRY)


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def test_small_functions(spark):
    lit = F.lit
    assert list(one(spark, text.digit_kinds(lit("১ ٣ 4")), text.digit_kinds(lit("4")), text.digit_kinds(lit(None).cast("string")))) == [["阿拉伯-印度数字", "孟加拉数字"], [], []]
    assert list(one(spark, *[text.without_fence(lit(t)) for t in ('```json\n{"a": 1}\n```', " ``` x ```", "x ```", "")])) == ['{"a": 1}', "x", "x ```", ""]
    assert list(one(spark, *[text.need_translate(lit(t)) for t in ("0.12, b\\frac{1}{2} ≤ π^2", "", "über", "四", "3 – 4")])) == [False, False, True, True, True]
    assert list(one(spark, *[text.latex_count(lit(t)) for t in ("$x$ and \\boxed{3} \\frac{1}{2}", "$" + "x" * 201 + "$", "\\boxed{" + "y" * 200 + "}")])) == [3, 0, 1]
    contents = ['"' + "x" * 900 + '"', '["a", {"text": "b"}, {"content": "c"}, {"text": 3, "content": "d"}, {"input": 1}]', "3", "null", "[]"]
    assert list(one(spark, *[sessions.content_text(lit(t)) for t in contents])) == ["x" * 800, "abcd", "", "", ""]
    values = F.create_map(lit("a"), lit("1"), lit("b"), lit(""))
    assert list(one(spark, parsers.template(lit("{{A}}-{{a}}"), values, strict=True), parsers.template(lit("{{a}} {{b}}"), values))) == ["1-1", ""]
    with pytest.raises(Exception, match="no value for b, c"):
        one(spark, parsers.template(lit("{{a}} {{b}} {{c}}"), values, strict=True))
    options = [(r["letter"], r["text"]) for r in one(spark, parsers.marked_options(lit("a ) a ) x , b ) y , b ) z , c ) w")))[0]]
    assert options == [("a", "x"), ("b", "z"), ("c", "w")]


def test_all_fields_of_a_translation(spark):
    rows = [("q 2", "q 2", ["1", "b"], ["1", "c"], "5", "5", "$x$", "$y$"), ("q 2", "q 3", ["1"], ["1", "2"], "5", "6", "$x$", "x"), ("q", " ", [], [], "", "", "", ""), ("a long question", "s", None, None, None, None, None, None)]
    d = spark.createDataFrame(rows, "q string, rq string, o array<string>, ro array<string>, a string, ra string, s string, rs string")
    c = F.col
    found = translation.all_problems({"question": c("q"), "options": c("o"), "answer": c("a"), "solution": c("s")}, {"question": c("rq"), "options": c("ro"), "answer": c("ra"), "solution": c("rs")}, F.lit("bn"))
    assert [r["f"] for r in d.select(found.alias("f")).collect()] == [[], ["options_count", "numbers_changed:question", "numbers_changed:options", "numbers_changed:answer", "latex_changed:solution"], ["empty_question"], ["length_ratio"]]


def test_pairs_by_place(spark):
    a, b = spark.createDataFrame([(f"a{k}", k) for k in range(5)], "id string, k int"), spark.createDataFrame([(f"b{k}", 2 * k) for k in range(8)], "id string, k int")
    got = [(r["at"], r["a"]["id"], r["b"]["id"], r["unpaired"]) for r in evalbuild.zipped(a, b, ["k"]).orderBy("at").collect()]
    assert got == [(k, f"a{k}", f"b{k}", 3) for k in range(5)]


def test_split_policies_and_first_rows(spark):
    d = spark.createDataFrame([(k, "d", "t", "", "", "", ["train", "test", "odd"][k % 3]) for k in range(30)], "id int, dataset string, task_type string, subject string, difficulty string, variant string, split string").withColumn("id", F.col("id").cast("string"))
    of = lambda policy, cap: [r["split"] for r in evalbuild.picked(d, "s", policy, default=cap).orderBy("pick").collect()]
    assert set(of("test-only", 30)) == {"test"} and of("test-first", 12)[:10] == ["test"] * 10 and "test" not in of("test-first", 12)[10:] and len(of("all", 12)) == 12 and len(set(of("all", 12))) > 1
    first = evalset.first_of_each(d.withColumn("row", F.lit("x")), [F.col("split")], [F.col("id").cast("int")])
    assert sorted((r["id"], r["row"]) for r in first.collect()) == [("0", "x"), ("1", "x"), ("2", "x")]


def test_lines_by_folder_and_bad_rows(spark, tmp_path):
    for name, lines in (("a/1.jsonl", "x\ny\n"), ("a/2.jsonl", "z"), ("a/b/1.jsonl", "w\n\n"), ("a/b/no.txt", "n")):
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_text(lines)
    writers.merge_each(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    got = sorted((r["folder"], r["value"]) for r in spark.read.text(str(tmp_path / "out")).collect())
    assert got == [("a", "x"), ("a", "y"), ("a", "z"), ("a/b", "w")]
    (tmp_path / "l.jsonl").write_text('{"a": 1}\n{"b": \n')
    with pytest.raises(Exception, match=r"l\.jsonl, line 2"):
        writers.lines_to_csv(spark, str(tmp_path / "l.jsonl"), str(tmp_path / "c"), "fail")


def test_scan_of_buckets(spark):
    said = [
        {"messages": [{"role": "user", "content": "你好吗"}, {"role": "assistant", "content": [{"type": "thinking", "thinking": "t"}, {"type": "text", "text": "abc"}, {"type": "tool_use", "input": {"x": 1}}]}, {"role": "tool", "content": "out"}]},
        {"messages": [{"role": "user", "content": [{"type": "tool_result", "content": "r"}]}, {"role": "user", "content": "hello"}, {"role": "system", "content": None}]}, {"other": 1},
    ]
    rows = [("b", json.dumps(s, ensure_ascii=False)) for s in said] + [("b", "{broken"), ("b", ""), ("c", "{}")]
    got = {r["bucket"]: r.asDict() for r in sessions.bucket_scan(spark.createDataFrame(rows, "bucket string, value string")).collect()}
    assert got["b"] == {"bucket": "b", "bytes": sum(len(v.encode()) + 1 for b, v in rows if b == "b" and v), "records": 3, "bad_lines": 1, "messages": 6, "chars": 3 + 3 + 7 + 3 + 1 + 5, "turns": 2, "thinking": 1, "tool_uses": 1, "users": 3, "assistants": 1, "tools": 1, "systems": 1, "zh": 1, "en": 1, "other": 1}
    assert got["c"]["records"] == 1 and got["c"]["messages"] == 0

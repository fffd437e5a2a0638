"""Fixtures for functions and operators that the driver's tables don't reach."""

import json
import os
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tamis.functions import text as T
from tamis.operators import evalbuild, evalset, evaluation, filters, normalizers, sessions, translation
from tamis.plans import normalizer_queries
from tamis.sources import readers, writers
from tamis.streaming import ingest


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("r")).first()["r"]


def test_text_functions(spark):
    assert one(spark, "claude-distills", T.field_slug) == "claude_distills"
    assert one(spark, "--a--", T.field_slug) == "a"
    assert one(spark, "　 A  b\n", T.norm_question) == "a b"
    assert one(spark, "۴૪", T.ascii_digits) == "44"
    assert [one(spark, x, T.need_translate) for x in ("4/3", "quatre", "四", "")] == [False, False, True, False]
    assert [one(spark, x, T.detect_lang) for x in (" ", "中" * 15 + "a" * 85, "中" * 14 + "a" * 86)] == ["other", "zh", "en"]
    assert one(spark, "2+2 #### 4 ", T.final_answer) == "4"
    assert one(spark, "no mark", T.final_answer) is None
    assert one(spark, "a<<1>>b<<2>>", T.count_steps) == 2
    assert [one(spark, x, T.norm_lang) for x in ("bangla", "German")] == ["bn", "ge"]


def test_cleaning(spark):
    cases = [
        ("", "x", [], "empty_question", None), ("a", "x", [], "question_too_short", None), ("q1", "", [], "empty_answer", None),
        ("q1", "2+2 #### 4", [], None, "4"), ("q1", "work ####", [], "malformed_gsm_answer", None), ("q1", "x", ["x"], "too_few_options", None),
        ("q1", "a) 40", ["a) 40", "b) 50"], None, "40"), ("q1", "B", ["apple pie", "banana"], None, "banana"),
        ("q1", "AB", ["apple pie", "banana"], None, "apple pie|banana"), ("q1", "D", ["apple pie", "banana"], "option_missing_for_letter", None),
        ("q1", "E", ["T", "E", "H"], None, "E"), ("q1", "zzz", ["apple", "banana"], "answer_not_in_options", None), ("q1", "zzz", ["apple", ""], None, "zzz"),
    ]
    d = spark.createDataFrame([(k, q, a, o, "", "") for k, (q, a, o, _, _) in enumerate(cases)], "k int, question string, answer string, options array<string>, solution string, split string")
    out = {r["k"]: r for r in evalset.cleaned(d).collect()}
    for k, (_, _, _, reason, answer) in enumerate(cases):
        assert out[k]["reject_reason"] == reason, cases[k]
        assert answer is None or out[k]["answer"] == answer
        assert out[k]["split"] == "unspecified"


def test_stratified_samples_are_prefixes(spark):
    d = spark.createDataFrame([(i, "s", "abc"[0 if i < 3 else 1 if i < 5 else 2]) for i in range(6)], "id int, source string, stratum string")
    key = evalset.sample_key(1, "source", "id")
    small = [r["id"] for r in evalset.stratified(d, "source", ["stratum"], key, "id", 2).orderBy("pick").collect()]
    large = evalset.stratified(d, "source", ["stratum"], key, "id", 4).orderBy("pick").collect()
    assert [r["id"] for r in large][:2] == small
    assert [r["stratum"] for r in large] == ["a", "b", "c", "a"]


def test_filters(spark):
    d = spark.createDataFrame([(k, json.dumps(x)) for k, x in enumerate([{"count": 5}, {"count": 5.0}, {}, {"ok": True}, {"answer-x": "hi"}])], "k int, j string")
    hit = lambda *f: [r["k"] for r in filters.where(d, *f, json_column="j").orderBy("k").collect()]
    assert hit("count = 5") == [0]
    assert hit("count >= 5") == [0, 1]
    assert hit("count != 9") == [0, 1]
    assert hit("ok = true") == [3]
    assert hit("answer-x != ''") == [4]
    assert hit("len(answer-x) > 1") == [4]
    assert hit("nope = 1") == []
    for bad in ("count > abc", "count ~ (", "count"):
        try:
            hit(bad)
            raise AssertionError(bad)
        except Exception as e:
            assert not isinstance(e, AssertionError)


def test_sorts_decide_on_the_whole_column(spark):
    d = spark.createDataFrame([("10",), ("2",), (None,)], "v string")
    assert [r["v"] for r in d.orderBy(filters.ordering(d, "v")).collect()] == ["2", "10", None]
    assert [r["v"] for r in d.orderBy(filters.ordering(d, "v", True)).collect()] == ["10", "2", None]
    mixed = d.union(spark.createDataFrame([("x",)], "v string"))
    assert [r["v"] for r in mixed.orderBy(filters.ordering(mixed, "v")).collect()] == ["10", "2", "x", None]


def test_session_categories(spark):
    block = lambda t, **x: json.dumps([{"type": t, **x}])
    u, a = ("user", '"hi"'), ("assistant", '"yes"')
    cases = [
        ([u], ["question"]), ([u, a], ["question", "question-answer"]), ([u, ("assistant", block("tool_use", name="f")), ("user", block("tool_result"))], ["question", "question-answer-tool-call"]),
        ([u, a, u], ["question", "question-multi"]), ([u, ("tool", '"x"')], ["question", "question-answer-tool-call"]), ([a], ["question-answer"]), ([("user", "[]")], ["question"]),
    ]
    d = spark.createDataFrame([(k, m) for k, (m, _) in enumerate(cases)], "k int, messages array<struct<role:string,content:string>>")
    got = {}
    for r in sessions.records(d).collect():
        got.setdefault(r["k"], []).append(r["category"])
    for k, (_, expected) in enumerate(cases):
        assert sorted(got.get(k, [])) == sorted(expected), k


def test_translation_checks(spark):
    d = spark.createDataFrame([("数 3 и 4.5 $x$", "number 3 and 4.5 $x$", "ru"), ("a 3", "b 4", "fr"), ("a", " ", "fr"), ("ab", "x" * 20, "fr")], "s string, t string, lang string")
    got = [r["p"] for r in d.select(translation.problems("s", "t", F.col("lang")).alias("p")).collect()]
    assert got == [[], ["numbers_changed"], ["empty_question"], ["length_ratio"]]


def test_readers_and_writers(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"id": "1", "v": 1}\n\nnot json\n{"id": "2", "v": 2}\n')
    rows = readers.json_lines(spark, str(p), "id string, v int").collect()
    assert sorted(r["id"] or "" for r in rows) == ["", "1", "2"] and sum(r["_bad"] is not None for r in rows) == 1
    assert [(r["line"], r["value"][:3]) for r in readers.numbered_lines(spark, str(p)).orderBy("line").collect()] == [(1, '{"i'), (2, ""), (3, "not"), (4, '{"i')]
    (tmp_path / "b.json").write_text('{"name": "x", "examples": [{"q": "1"}, {"q": "2"}]}')
    assert sorted(r["q"] for r in readers.json_array(spark, str(tmp_path / "b.json"), "q string").collect()) == ["1", "2"]
    (tmp_path / "c.csv").write_text('﻿a,b\n"x\ny",2\n')
    assert readers.delimited(spark, str(tmp_path / "c.csv")).collect()[0].asDict() == {"a": "x\ny", "b": "2"}
    d = spark.createDataFrame([("d1", "en", "q"), ("d1", "fr", "r"), ("d1", "", "s")], "dataset string, lang string, question string")
    writers.write_by_language(d, str(tmp_path / "split"))
    assert sorted(r["bucket"] for r in spark.read.json(str(tmp_path / "split")).collect()) == ["other-lang", "zh-en"]
    writers.write_normalized(d.select(*writers.record(dataset=F.col("dataset"), question=F.col("question"))), str(tmp_path / "norm"), ["question"])
    assert sorted(r["id"] for r in spark.read.json(str(tmp_path / "norm")).collect()) == ["d1-000000", "d1-000001", "d1-000002"]


def test_raw_readers(spark, tmp_path):
    import zipfile

    import pyarrow as pa

    (tmp_path / "a.jsonl").write_text('{"q": 1}\n\nbad\n')
    assert [(r["at"], r["q"]) for r in readers.raw_lines(spark, str(tmp_path / "a.jsonl")).selectExpr("at", "variant_get(row, '$.q', 'int') as q").orderBy("at").collect()] == [(0, 1), (2, None)]
    assert readers.count_lines(spark, str(tmp_path / "a.jsonl")) == 3 and readers.count_lines(spark, str(tmp_path / "none")) == 0
    for name, text in (("x.json", '[{"q": 1}, {"q": 2}]'), ("y.json", '{"keywords": "k", "example": [{"q": 3}]}'), ("z.json", '{"name": "n", "odd": [{"q": 4}], "even": [{"q": 5}]}')):
        (tmp_path / name).write_text(text)
    rows = readers.raw_array(spark, str(tmp_path / "*.json"), str(tmp_path)).selectExpr("file", "at", "variant_get(row, '$.q', 'int') as q", "try_variant_get(top, '$.keywords', 'string') as k").collect()
    assert sorted((r["file"], r["at"], r["q"], r["k"]) for r in rows) == [("x.json", 0, 1, None), ("x.json", 1, 2, None), ("y.json", 0, 3, "k"), ("z.json", 0, 4, None)]
    with zipfile.ZipFile(tmp_path / "f.zip", "w") as z:
        z.writestr("dev/law_dev.csv", "\ufeffid,question\n1,\"a\nb\"\n")
        z.writestr("test/law.csv", "id\n2\n")
    got = readers.zipped_csv(spark, str(tmp_path / "f.zip"), "dev/").selectExpr("file", "variant_get(row, '$.question', 'string') as q", "variant_get(row, '$.id', 'string') as id").collect()
    assert [(r["file"].split("/")[-1] == "law_dev.csv", r["q"], r["id"]) for r in got] == [(True, "a\nb", "1")]
    with pa.OSFile(str(tmp_path / "s.arrow"), "wb") as f, pa.ipc.new_stream(f, pa.schema([("q", pa.int64())])) as w:
        w.write_batch(pa.record_batch([pa.array([7, 8])], names=["q"]))
    assert [r["q"] for r in readers.arrow_stream(spark, str(tmp_path / "s.arrow")).orderBy("at").selectExpr("variant_get(row, '$.q', 'int') as q").collect()] == [7, 8]
    task = tmp_path / "tasks" / "t1" / "solution"
    task.mkdir(parents=True)
    (task / "solve.sh").write_text("ls")
    (task.parent / "instruction.md").write_text("Do it")
    raw = readers.task_directories(spark, str(tmp_path / "tasks"))
    r = normalizers.normalize(raw, "Terminal_Bench").first()
    assert (r["question"], r["answer"], r["orig_id"], r["reject_reason"]) == ("Do it", "ls", "t1", None)
    with pytest.raises(KeyError):
        normalizers.find("none")


def test_lines_of_large_files_are_numbered_across_blocks(spark, tmp_path):
    p = tmp_path / "big.txt"
    p.write_text("".join(f"line {k}\n" if k % 7 else "\n" for k in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = readers.numbered_lines(spark, str(p)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r["line"], r["value"]) for r in rows) == [(k + 1, f"line {k}" if k % 7 else "") for k in range(5000)]


def test_sinks(spark, tmp_path):
    d = spark.createDataFrame([("question", "s1", "a"), ("question", "s2", "b")], "category string, source string, m string")
    writers.write_by_category(d, str(tmp_path / "cat"))
    writers.write_by_category(d.where("source = 's1'").withColumn("m", F.lit("c")), str(tmp_path / "cat"))
    assert sorted((r["source"], r["m"]) for r in spark.read.json(str(tmp_path / "cat")).collect()) == [("s1", "c"), ("s2", "b")]
    writers.write_csv(d, str(tmp_path / "csv"), mark=True, columns=["m", "source"])
    assert next((tmp_path / "csv").glob("*.csv")).read_bytes().startswith(b"\xef\xbb\xbfm,source")
    (tmp_path / "l.jsonl").write_text('{"b": 1, "a": "x,y"}\nbad\n{"c": [1]}\n')
    assert writers.lines_to_csv(spark, str(tmp_path / "l.jsonl"), str(tmp_path / "u")) == ["b", "a", "c"]
    got = spark.read.option("header", True).csv(str(tmp_path / "u")).collect()
    assert sorted((r["a"] or "", r["b"] or "", r["c"] or "") for r in got) == [("", "", "[1]"), ("x,y", "1", "")]
    good, bad = writers.split_rejects(d, F.when(F.col("m") == "a", "empty"))
    assert [r["m"] for r in good.collect()] == ["b"] and [r["reject_reason"] for r in bad.collect()] == ["empty"]
    with pytest.raises(ValueError):
        evalbuild.strict_union([d, d.select("m")])
    assert evalbuild.unknown(d.withColumnRenamed("source", "dataset"), ("s1", "nope")) == ["nope"]


def test_places_of_a_group_that_spans_tasks(spark):
    d = spark.range(3000).selectExpr("case when id % 3 = 0 then 'hot' when id % 3 = 1 then null else 'x' || id % 5 end as g", "3000 - id as v")
    rows = evalset.numbered(d, "g", ["v"]).collect()
    by = {}
    for r in rows:
        by.setdefault(r["g"], []).append((r["v"], r["n"]))
    assert all([n for _, n in sorted(x)] == list(range(len(x))) for x in by.values()) and len(rows) == 3000


def test_judge_settings_and_columns():
    assert evaluation.check_judge(0, 1, 0.6, ["a"], {"a": 1.0}, 1, "x_{{referee}}") == []
    assert len(evaluation.check_judge(1, 1, 2, ["a"], {"b": 1.0}, 0, "x")) == 5
    assert evaluation.question_column(["id", "text", "prompt"]) == "prompt" and evaluation.question_column(["id"]) is None
    assert evaluation.family("other-5", ("usage", "answer")) == [f"{c}_other_5" for c in ("answer", "prompt_tokens", "cached_tokens", "completion_tokens", "reasoning_tokens", "total_tokens", "error")]


def test_ingest_resumes(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for k, ids in enumerate((("1", "2"), ("2", "3"))):
        (src / f"{k}.json").write_text("".join(f'{{"id": "{i}"}}\n' for i in ids))
        ingest.follow(spark, str(src), "id string", str(tmp_path / "done"), str(tmp_path / "ck")).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "done")).collect()) == ["1", "2", "3"]


def test_ingest_finds_rows_without_keys_again(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for k in range(2):  # the same rows twice, as after a lost checkpoint
        (src / f"{k}.json").write_text('{"v": "a"}\n{"v": "b"}\n{"id": "1", "v": "c"}\n')
        ingest.follow(spark, str(src), "id string, v string", str(tmp_path / "done"), str(tmp_path / f"ck{k}")).awaitTermination()
    assert sorted(r["v"] for r in spark.read.parquet(str(tmp_path / "done")).collect()) == ["a", "b", "c"]


def test_entry_without_llm(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(os.path.join(root, "tamis"), tmp_path / "tamis", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), *sorted(set(e.queries()) ^ set(e.oracle_sql())))"], cwd=tmp_path, env=os.environ | {"PYTHONPATH": ""}, capture_output=True, text=True)
    assert said.stdout.split()[1:] == ["profile_sketches", "vector_neighbours"] and int(said.stdout.split()[0]) > 100, said.stderr


@pytest.mark.parametrize("name", ["norm_gaokao_bench", "norm_halluqa"])
def test_options_of_a_question_are_worked_out_once(spark, tmp_path, capsys, name):
    """However many fields read them; and one file of narrow rows makes as many tasks as there are partitions."""
    spark.range(1, 401).selectExpr("id as p_partkey", "'a b' as p_name", "'Brand#1' as p_brand", "'T' as p_type", "cast(id % 50 as int) as p_size").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    d = normalizer_queries.QUERIES[name](spark, str(tmp_path))
    assert d.count() == 400
    assert d.select("rid", "answer", F.spark_partition_id().alias("p")).agg(F.countDistinct("p")).first()[0] == 4
    capsys.readouterr()
    d.explain()
    assert capsys.readouterr().out.count("regexp_extract_all(") == 1
    raw = spark.range(1).selectExpr("'GAOKAO-Bench/x_MCQs_mc.json' as file", """parse_json('{"question": "q A: x B: y", "answer": "A"}') as row""", "'s' as stem", "'n' as named", "'l' as letter")
    r = normalizers.normalize(raw, "GAOKAO-Bench" if "gaokao" in name else "HalluQA").first()
    assert (r["stem"], r["named"], r["letter"]) == ("s", "n", "l")  # columns of the caller's go through


def test_numbered_rows_stay_where_they_are(spark, capsys):
    """A few places of groups are joined to the rows: those aren't shuffled once more for it."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        d = evalset.numbered(spark.range(20_000).selectExpr("id % 3 as g", "uuid() as t", "id as k"), "g", ["k"])
        capsys.readouterr()
        d.explain()
        plan = capsys.readouterr().out
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
        assert d.where("n <> (k - g) / 3").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

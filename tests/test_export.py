"""Exports: whole, in order, or not there; counts of the pass that writes."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tamis.sources import export


def whole(folder):
    return b"".join(open(os.path.join(folder, n), "rb").read() for n in sorted(os.listdir(folder)) if n.startswith("part-"))


def rows(spark, n=500):
    return spark.range(n).select((n - F.col("id")).alias("k"), F.concat(F.lit('é "'), F.col("id").cast("string"), F.lit('",\n')).alias("t"), F.when(F.col("id") % 3 > 0, F.array(F.lit("a"))).alias("l"), (F.col("id") % 2 == 0).alias("b"))


def test_csv_in_one_order_with_one_mark(spark, tmp_path):
    path = str(tmp_path / "out.csv")
    export.export(rows(spark).repartition(7), path, order=["k"], mark=True)
    text = whole(path).decode("utf-8")
    assert text.startswith("﻿k,t,l,b\n") and text.count("﻿") == 1
    import csv
    import io

    got = list(csv.DictReader(io.StringIO(text.removeprefix("﻿"))))
    assert [int(r["k"]) for r in got] == list(range(1, 501)) and got[0]["t"] == 'é "499",\n' and {r["l"] for r in got} == {"", '["a"]'} and got[1]["b"] == "true"
    export.one_file(spark, path, str(tmp_path / "one.csv"))
    assert (tmp_path / "one.csv").read_bytes() == whole(path) and not (tmp_path / "one.csv.partial").exists()
    with pytest.raises(FileExistsError):
        export.one_file(spark, path, str(tmp_path / "one.csv"))


def test_refuses_to_overwrite(spark, tmp_path):
    path = str(tmp_path / "out.jsonl")
    export.export(rows(spark, 3), path, order=["k"])
    before = whole(path)
    assert [json.loads(x)["k"] for x in before.decode().splitlines()] == [1, 2, 3]
    with pytest.raises(Exception, match="is there"):
        export.export(rows(spark, 5), path)
    assert whole(path) == before
    export.export(rows(spark, 5), path, order=[F.desc("k")], overwrite=True)
    assert [json.loads(x)["k"] for x in whole(path).decode().splitlines()] == [5, 4, 3, 2, 1]
    export.export(rows(spark, 0), str(tmp_path / "none.csv"))
    assert whole(str(tmp_path / "none.csv")) == b"k,t,l,b\n"


@pytest.mark.parametrize("how", ["raises", "dies"])
def test_a_failed_task_leaves_nothing(spark, tmp_path, how):
    def run(batches):
        for b in batches:
            if 777 in b.column(0).to_pylist():
                if how == "dies":
                    os._exit(9)
                raise ValueError("no")
            yield b

    d = spark.range(1_000).repartition(4).mapInArrow(run, "id long")
    with pytest.raises(Exception):
        export.export(d, str(tmp_path / "x.jsonl"))
    assert os.listdir(tmp_path) == []
    export.export(spark.range(3), str(tmp_path / "x.jsonl"))
    with pytest.raises(Exception):
        export.export(d, str(tmp_path / "x.jsonl"), overwrite=True)
    assert os.listdir(tmp_path) == ["x.jsonl"] and len(whole(str(tmp_path / "x.jsonl")).splitlines()) == 3


def test_counts_of_the_pass(spark, tmp_path):
    d = spark.range(100).select("id", F.concat(F.lit("t"), F.col("id").cast("string")).alias("t"), F.when(F.col("id") % 5 == 0, "empty").when(F.col("id") % 7 == 0, "odd").when(F.col("id") == 1, "new").alias("why"))
    got = export.write_counted(d, str(tmp_path / "w"), "why", ["empty", "odd", "never"], ["t"])
    back = spark.read.json(str(tmp_path / "w"))
    assert got == {"rows": 100, "written": back.where("outcome = 'written'").count(), "chars": sum(len(r["t"]) for r in back.where("outcome = 'written'").collect()), "other": 1, "empty": 20, "odd": 12, "never": 0}
    lines, seen = export.line_counts(spark.createDataFrame([('{"a": 1}',), ("",), ("  ",), ("[1]",), ("{",), ('{"é": 2}',)], "value string"))
    assert lines.count() == 2 and seen.get == {"bytes": 9 + 1 + 3 + 4 + 2 + 10, "blank": 2, "bad": 2, "records": 2}

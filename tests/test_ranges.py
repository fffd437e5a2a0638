"""Readers over byte ranges: whatever the block, rows are those of the whole file."""

import csv
import io
import json
import random
import zipfile

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tamis.sources import byte_ranges, json_index, readers


def test_lines_by_ranges_are_the_lines(spark, tmp_path):
    rng = random.Random(1)
    byte_ranges.register(spark)
    for n, text in enumerate([b"", b"\n", b"a", b"a\r\nb\n\n\nc", b"x" * 50 + b"\n" + b"\xff\n", b"\n".join(b"y" * rng.randrange(12) for _ in range(60))]):
        (tmp_path / str(n)).mkdir()
        (tmp_path / str(n) / "f.txt").write_bytes(text)
        want = text.split(b"\n")
        want = [x.removesuffix(b"\r").decode("utf-8", "replace") for x in (want[:-1] if want[-1] == b"" else want)]
        for block in (3, 10, 1 << 20):
            rows = spark.read.format("tamis_lines").option("block", block).load(str(tmp_path / str(n))).orderBy("block", "nth").collect()
            assert [r["value"] for r in rows] == want, (n, block)
            assert all(r["offset"] >= r["block"] for r in rows)


def test_a_bad_line_is_named(spark, tmp_path):
    (tmp_path / "g.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n' * 5_000 + '{"a": oops}\n')
    with pytest.raises(Exception, match=r"g\.jsonl, line 15001"):
        readers.json_lines(spark, str(tmp_path / "g.jsonl"), "a int", "fail").count()
    (tmp_path / "h.jsonl").write_text('{"a": 1, "a": 3}\n \n{"a": 2}\n')
    assert [r["a"] for r in readers.json_lines(spark, str(tmp_path / "h.jsonl"), "a int", "fail").collect()] == [3, 2]  # the last of equal keys


def test_format_by_extension(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,t\n1,"x, y"\nz,w\n')
    (tmp_path / "a.tsv").write_text("id\tt\n2\tq\n")
    (tmp_path / "a.jsonl").write_text('{"id": 3, "t": "r"}\n')
    spark.createDataFrame([(4,)], "id int").write.parquet(str(tmp_path / "a.parquet"))
    got = {e: [(r["id"], r["t"]) for r in readers.by_extension(spark, str(tmp_path / f"a.{e}"), "id int, t string").collect()] for e in ("csv", "tsv", "jsonl", "parquet")}
    assert got == {"csv": [(1, "x, y"), (None, "w")], "tsv": [(2, "q")], "jsonl": [(3, "r")], "parquet": [(4, None)]}
    with pytest.raises(ValueError, match="no format"):
        readers.by_extension(spark, "a.xyz", "id int")


def awkward(rng):
    texts = ['a"b', "[{,", '\\', "\\\\\"", "]}", "é\n,", "", "x" * rng.randrange(40)]
    value = lambda deep=0: rng.choice([None, True, rng.randrange(99), rng.choice(texts), [value(deep + 1) for _ in range(rng.randrange(3))] if deep < 3 else 1, {rng.choice(texts): value(deep + 1) for _ in range(2)} if deep < 3 else {}])
    return [value() for _ in range(rng.randrange(1, 30))]


def test_array_elements_at_any_block_edge(spark, tmp_path):
    rng = random.Random(7)
    want = {}
    for n in range(12):
        items = awkward(rng)
        kind = n % 4
        whole = items if kind == 0 else {"note": 'x"[', "keywords": [1, {"a": []}], "data": items, "z": {"test": [5]}} if kind == 1 else {"s": {"q": [1]}, "rows": items} if kind == 2 else items
        (tmp_path / f"f{n}.json").write_text(json.dumps(whole, indent=rng.choice([None, 1]), ensure_ascii=n % 3 == 0), encoding="utf-8")
        if kind == 1:
            whole["data"] = []
        elif kind == 2:
            whole["rows"] = []
        want[f"f{n}.json"] = (items, whole if kind in (1, 2) else None)
    (tmp_path / "none.json").write_text('{"a": {"b": 1}}')
    (tmp_path / "empty.json").write_text(" [ \n ] ")
    (tmp_path / "text.json").write_text('"[1,2]"')
    for block in (13, 64, 1 << 22):
        got = {}
        for r in json_index.elements(spark, str(tmp_path), block=block).orderBy("file", "at").collect():
            name = r["file"].rsplit("/", 1)[1]
            got.setdefault(name, ([], None if r["top"] is None else json.loads(r["top"])))[0].append(json.loads(r["value"]))
            assert r["at"] == len(got[name][0]) - 1
        assert got == want, block


def test_one_array_is_read_by_many_tasks(spark, tmp_path):
    (tmp_path / "big.json").write_text(json.dumps([{"k": k, "t": "[,]" * 30} for k in range(5_000)]))
    d = json_index.elements(spark, str(tmp_path / "big.json"), block=20_000)
    assert d.select(F.spark_partition_id()).distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [r["k"] for r in d.select("at", F.get_json_object("value", "$.k").cast("int").alias("k")).orderBy("at").collect()] == list(range(5_000))


def test_arrow_streams_by_batches(spark, tmp_path):
    schema = pa.schema([("n", pa.int64()), ("s", pa.dictionary(pa.int32(), pa.string())), ("l", pa.list_(pa.string()))])
    with pa.OSFile(str(tmp_path / "s.arrow"), "wb") as f, pa.ipc.new_stream(f, schema) as w:
        for k in range(9):
            w.write_batch(pa.record_batch([pa.array(range(k * 10, k * 10 + 10)), pa.array([f"v{k % 3}"] * 10).dictionary_encode(), pa.array([["a", None]] * 10)], schema=schema))
    for block in (1, 1_000, 1 << 20):
        byte_ranges.register(spark)
        d = spark.read.format("tamis_arrow").option("block", block).load(str(tmp_path / "s.arrow"))
        rows = [(r["at"], json.loads(r["json"])) for r in d.orderBy("at").collect()]
        assert rows == [(n, {"n": n, "s": f"v{n // 10 % 3}", "l": ["a", None]}) for n in range(90)]
        if block == 1:
            assert d.select(F.spark_partition_id()).distinct().count() == 9


def test_members_of_archives(spark, tmp_path):
    for n in range(3):
        with zipfile.ZipFile(tmp_path / f"z{n}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            for k in range(3):
                text = io.StringIO()
                w = csv.writer(text)
                w.writerow(["q", "id"])
                w.writerows([[f'say "{j}",\n{n}', k] for j in range(50)])
                z.writestr(f"dev/m{k}.csv", ("﻿" if k else "") + text.getvalue())
            z.writestr("test/other.csv", "q\nno\n")
    d = readers.zipped_csv(spark, str(tmp_path / "z*.zip"), "dev/")
    assert d.select(F.spark_partition_id()).distinct().count() == 9
    got = sorted((r["file"].removeprefix(f"{tmp_path}/"), r["at"], json.loads(r["j"])) for r in d.select("file", "at", F.to_json("row").alias("j")).collect())
    assert [x[:2] for x in got] == [(f"z{n}.zip!dev/m{k}.csv", j) for n in range(3) for k in range(3) for j in range(50)]
    assert got[1][2] == {"q": 'say "1",\n0', "id": "0"}


def test_blocks_of_an_array_are_found_once_and_dealt_out(spark, tmp_path, capsys):
    path = tmp_path / "many.json"
    path.write_text(json.dumps([{"k": k, "t": 'a\\"[,' * 20} for k in range(2_000)]))
    byte_ranges.register(spark)
    ranges = spark.read.format("tamis_ranges").options(block=1_000, tasks=4).load(str(path))
    rows = [tuple(r)[1:] for r in ranges.orderBy("start").collect()]
    assert rows == [(k, min(k + 1_000, path.stat().st_size)) for k in range(0, path.stat().st_size, 1_000)]
    assert ranges.rdd.getNumPartitions() == 4  # not a task for each of the hundreds of blocks
    d = json_index.elements(spark, str(path), block=1_000)
    assert sorted(json.loads(r["value"])["k"] for r in d.collect()) == list(range(2_000))
    joins = {spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), "-1"}
    for size in joins:  # whichever join stands before
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
        try:
            d = json_index.elements(spark, str(path), block=1_000)
            assert d.select(F.spark_partition_id()).distinct().count() == 4
            capsys.readouterr()
            json_index.elements(spark, str(path), block=1_000).explain()
            plan = capsys.readouterr().out
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert plan.count("tamis_ranges") == 0  # the states of the blocks aren't worked out again wherever they are used
        assert plan.count("REPARTITION_BY_NUM") == 2  # before counts and elements: none is left to one task


def test_the_element_behind_a_block_costs_little(tmp_path):
    path = tmp_path / "f.json"
    path.write_text("[" + ",".join(json.dumps("x" * 90) for _ in range(20_000)) + "]")
    taken = []

    class Counted:
        def __init__(self, f):
            self.f = f

        def read(self, n):
            taken.append(n)
            return self.f.read(n)

        def __getattr__(self, name):
            return getattr(self.f, name)

    with byte_ranges.opened(str(path)) as f:
        got = json_index.found_in(Counted(f), 0, 1_000, 0, 0, 0, (1 << 63) - 1, 1, True)
    assert [json.loads(x) for x in got] == ["x" * 90] * 11
    assert sum(taken) < 100_000  # of 1.9 MB


def test_structure_of_blocks_is_that_of_bytes():
    rng = random.Random(5)
    for _ in range(400):
        text = bytes(rng.choice(b'\\\\\\""[]{},: a') for _ in range(rng.randrange(40)))
        run, inside = rng.randrange(3), rng.randrange(2)
        want, slashes, now = [], run, inside
        for k, b in enumerate(text):
            if b == 34 and slashes % 2 == 0:
                now ^= 1
            elif b in b"[]{},:" and not now:
                want.append((k, b, 1 if b in b"[{" else -1 if b in b"]}" else 0))
            slashes = slashes + 1 if b == 92 else 0
        places, bytes_, steps, quotes = json_index.outside(np.frombuffer(text, np.uint8), inside, run)
        assert list(zip(places.tolist(), bytes_.tolist(), steps.tolist(), strict=True)) == want
        assert (inside + quotes) % 2 == now

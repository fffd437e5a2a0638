"""Resumable calls, and session logs that grow between triggers."""

import json
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tamis.operators.session_logs import codex
from tamis.streaming import calls, logs


def flaky():
    """Fails by a number of the key: some never, some until asked again, some always."""

    def call(row):
        k = zlib.crc32(str(row["id"]).encode()) % 10
        if k == 0:
            raise calls.Unusable("no JSON")
        if k == 1:
            raise RuntimeError("broken")
        if k in (2, 3) and random.random() < 0.5:
            raise calls.Busy("429", after=0.5)
        return {"answer": f"a{row['id']}", "size": len(row["q"])}

    return call


def test_each_key_stands_once_in_one_sink_after_restarts(spark, tmp_path):
    queue, folder, check = str(tmp_path / "queue"), str(tmp_path / "out"), str(tmp_path / "check")
    rows = [(k, "q" * (k % 7)) for k in range(400)]
    for n in range(8):
        part = rows[50 * n : 50 * n + 50] + rows[:5]  # some keys come again and again
        spark.createDataFrame(part, "id long, q string").coalesce(1).write.mode("append").json(queue)
    how = dict(queue_schema="id long, q string", key="id", function=flaky(), schema="answer string, size int", folder=folder, checkpoint=check, files=2, attempts=12, concurrency=4, wait=lambda s: None)
    write, seen = calls._write, []

    def crash(rows, path):
        seen.append(path)
        if len(seen) == 3:
            write(rows.limit(3), path)  # what a batch that is cut off may leave
            raise OSError("gone")
        write(rows, path)

    calls._write = crash
    try:
        with pytest.raises(Exception, match="gone"):
            calls.follow(spark, queue, **how).awaitTermination()
        assert calls.outcomes(spark, folder).count() < 400
        calls.follow(spark, queue, **how).awaitTermination()
    finally:
        calls._write = write
    assert seen[2] == seen[3]
    ended = calls.outcomes(spark, folder)
    assert ended.count() == ended.select("id").distinct().count() == 400
    good, bad = calls.done(spark, folder, "id"), calls.failed(spark, folder, "id")
    assert good.count() + bad.count() == 400 and good.where("answer <> concat('a', id) or size <> length(q) or error is not null").count() == 0
    kinds = {r["id"]: zlib.crc32(str(r["id"]).encode()) % 10 for r in bad.collect()}
    assert set(kinds.values()) == {0, 1} and {r["id"]: r["attempts"] for r in bad.collect()} == {i: 12 if k == 0 else 1 for i, k in kinds.items()}
    calls.again(spark, ["id", "q"], "id", lambda r: {"answer": "late", "size": 1}, "answer string, size int", folder)
    assert calls.failed(spark, folder, "id").count() == 0 and calls.done(spark, folder, "id").where("answer = 'late'").count() == len(kinds)
    calls.follow(spark, queue, **how).awaitTermination()
    assert calls.done(spark, folder, "id").count() == 400


def test_waits_grow(spark, tmp_path):
    log = tmp_path / "waits"

    def wait(seconds):
        with open(log, "a") as f:
            f.write(f"{seconds}\n")

    def fails(row):
        raise calls.Busy(after=5) if row["id"] == 1 else calls.Unusable()

    waits = {}
    for k in (1, 2):
        row = calls.called(spark.createDataFrame([(k,)], "id int"), fails, "x int", attempts=4, wait=wait).first()
        waits[k] = [float(x) for x in log.read_text().split()]
        log.unlink()
        assert row["attempts"] == 4 and row["x"] is None and row["error"].startswith("Busy" if k == 1 else "Unusable")
    assert waits == {1: [5, 5, 8], 2: [1.5, 2.25, 3.375]}


def events(s):
    rng, out = random.Random(s), []
    for _ in range(120):
        k = rng.randrange(10)
        if k == 0:
            out.append({"type": "session_meta", "payload": {"id": f"s{rng.randrange(3)}"}})
        elif k == 1:
            out.append({"type": "event_msg", "payload": {}})
        elif k < 4:
            out.append({"type": "response_item", "payload": {"type": "message", "role": rng.choice(["user", "developer"]), "content": [{"text": f"é {rng.random()}"}]}})
        else:
            out.append({"type": "response_item", "payload": rng.choice([{"type": "message", "role": "assistant", "content": [{"text": f"t{rng.random()}"}]}, {"type": "function_call", "name": "f", "arguments": "{}"}, {"type": "reasoning", "summary": [{"text": "hm"}]}])})
    return "".join(json.dumps(e, ensure_ascii=False) + "\n" for e in out).encode() + b"no json\n"


def test_files_that_grow_give_the_batch_result(spark, tmp_path):
    path, table, check = tmp_path / "logs", str(tmp_path / "spans"), str(tmp_path / "check")
    path.mkdir()
    whole = {f"f{k}.jsonl": events(k) for k in range(4)}
    rng = random.Random(3)
    upto = dict.fromkeys(whole, 0)
    for step in range(4):
        for name, text in whole.items():
            if step == 0 and name == "f3.jsonl":
                continue
            upto[name] = len(text) if step == 3 else rng.randrange(upto[name], len(text))  # cuts lines, even letters
            (path / name).write_bytes(text[: upto[name]])
        logs.follow(spark, str(path), table, check).awaitTermination()
    kept = spark.read.schema("file string, session string, at long, island long, item string").parquet(table)
    said = lambda d: {(r["file"].rsplit("/", 1)[-1], r["session"]): [(m["role"], m["content"]) for m in r["messages"]] for r in d.collect()}
    lines = [(n, k, x) for n, text in whole.items() for k, x in enumerate(text.decode().splitlines())]
    want = said(codex(spark.createDataFrame(lines, "file string, at long, v string").select("file", "at", F.try_parse_json("v").alias("row"))))
    got = said(logs.assembled(kept))
    assert len(want) >= 8 and got == want

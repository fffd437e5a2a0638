"""The segmented scan against windows over whole groups."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamis.operators.scan import scanned
from tamis.operators.session_logs import codex, pi


def expected(rows, keys, order):
    upto = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumns({"last": F.last("value", ignorenulls=True).over(upto), "total": F.sum(F.coalesce("n", F.lit(0))).over(upto), "prior": F.last("value", ignorenulls=True).over(before)})


def both(rows, keys, order):
    got = scanned(rows, keys, order, lasts={"last": F.col("value")}, sums={"total": F.col("n")}, previous={"prior": F.col("value")})
    want = expected(rows, keys, order)
    return sorted(map(str, got.select(*want.columns).collect())), sorted(map(str, want.collect()))


def test_equals_the_window_on_a_group_that_spans_tasks(spark):
    rows = spark.range(5_000).select(
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 30 > 0, F.concat(F.lit("f"), (F.col("id") % 17).cast("string"))).alias("file"),
        F.when(F.col("id") > 5, F.xxhash64("id") % 1_000_000).alias("at"), F.col("id").alias("k0"), F.when(F.col("id") % 41 == 0, F.col("id").cast("string")).alias("value"),
        F.when(F.col("id") % 7 > 0, F.col("id") % 5).alias("n"), F.lit("clash").alias("part"), F.lit("clash").alias("row"))
    for keys, order in ((["file"], ["at", "k0"]), ([], ["at", "k0"])):
        got, want = both(rows, keys, order)
        assert got == want
    got, want = both(rows.where("false"), ["file"], ["at", "k0"])
    assert got == want == []


def test_no_task_holds_a_hot_group(spark):
    rows = spark.range(40_000).select(F.lit("one").alias("file"), F.col("id").alias("at"), F.when(F.col("id") % 10_000 == 0, F.col("id")).alias("value"))
    out = scanned(rows, ["file"], ["at"], lasts={"last": F.col("value")})
    assert out.where("last <> at - at % 10000").count() == 0
    sizes = [r["count"] for r in out.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()]
    assert sum(sizes) == 40_000
    blocks = out._jdf.queryExecution().optimizedPlan().toString()
    assert "part" in blocks  # windows run by block, not by file


def log(spark, rows):
    return spark.createDataFrame(rows, "file string, at long, json string").select("file", "at", F.try_parse_json("json").alias("row"))


def test_one_log_file_over_many_blocks(spark):
    rows, want = [("f", 0, '{"type":"session_meta","payload":{"id":"s0"}}')], {}
    at = 0
    for s in range(40):
        at += 1
        rows.append(("f", at, f'{{"type":"session_meta","payload":{{"id":"s{s % 30}"}}}}'))
        for k in range(50):
            at += 1
            role = "user" if k % 5 == 0 else "assistant"
            rows.append(("f", at, f'{{"type":"response_item","payload":{{"type":"message","role":"{role}","content":[{{"text":"t{at}"}}]}}}}'))
            turns = want.setdefault(f"s{s % 30}", [])
            if role == "user" or not turns or turns[-1][0] == "user":
                turns.append((role, []))
            turns[-1][1].append(f"t{at}")
    got = {r["session"]: [(m["role"], m["content"]) for m in r["messages"]] for r in codex(log(spark, rows)).collect()}
    assert set(got) == set(want)
    for name, turns in want.items():
        assert [m[0] for m in got[name]] == [t[0] for t in turns]
        for (_, content), (_, texts) in zip(got[name], turns, strict=True):
            assert [content.find(f'"{t}"') >= 0 for t in texts] == [True] * len(texts)


def test_session_marks_over_many_blocks(spark):
    rows = [("f", 100 * s + k, f'{{"type":"session","id":"s{s % 7}"}}' if k == 0 else f'{{"type":"message","message":{{"role":"user","content":"m{s}.{k}"}}}}') for s in range(60) for k in range(10)]
    got = sorted((r["session"], [m["content"] for m in r["messages"]]) for r in pi(log(spark, rows)).collect())
    assert got == sorted((f"s{s % 7}", [f'"m{s}.{k}"' for k in range(1, 10)]) for s in range(60))

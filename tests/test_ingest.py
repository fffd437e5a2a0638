"""Profiles, manifests, neighbours and plug-ins."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamis.operators import evalbuild, evalset, manifest, normalizers, plugins, profile, vectors


def test_sketches_of_merged_loads_are_near_the_truth(spark):
    d = spark.range(60_000).select(F.col("id").alias("k"), (F.col("id") * F.col("id") % 1_000).cast("double").alias("v"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), (F.col("id") % 5_000).cast("string"))).alias("t"),
                                   F.when(F.col("id") % 2 == 0, F.lit('{"a": 1, "b": ["x"]}')).alias("j"), F.lit(None).cast("int").alias("none"))
    loads = [profile.states(d.where(F.pmod("k", F.lit(3)) == i)) for i in range(3)]
    got = {r["column"]: r for r in profile.read(profile.merged(loads[0].unionByName(loads[1]).unionByName(loads[2]))).collect()}
    for column, truth in (("k", 60_000), ("v", d.select("v").distinct().count()), ("t", d.select("t").distinct().count())):
        assert abs(got[column]["distinct"] - truth) <= 0.05 * truth
    v = np.array([r["v"] for r in d.select("v").collect()])
    for q, x in zip((0.25, 0.5, 0.75), got["v"]["quartiles"], strict=True):
        assert np.mean(v < x) - 0.03 <= q <= np.mean(v <= x) + 0.03
    assert got["t"]["frequent"][0]["item"] == "hot" and abs(got["t"]["frequent"][0]["count"] - 20_000) <= 600
    assert got["j"]["shape"] == "OBJECT<a: BIGINT, b: ARRAY<STRING>>" and got["j"]["nulls"] == 30_000
    assert got["none"]["nulls"] == got["none"]["n"] == 60_000 and got["none"]["quartiles"] is None and got["none"]["distinct"] == 0
    assert [r["n"] for r in profile.read(profile.states(d.where("false"))).collect()] == [0] * 5


def test_a_manifest_names_what_changed(spark):
    rows = [(k, f"p{k % 3}" if k % 5 else None, f"text {k}" if k % 7 else None) for k in range(400)]
    d = spark.createDataFrame(rows, "id long, part string, text string")
    kept = manifest.manifest(d, "id", "part").cache()
    same = d.repartition(7).select("text", "id", "part")
    assert sorted(map(str, manifest.manifest(same, "id", "part").collect())) == sorted(map(str, kept.collect()))
    assert manifest.verified(same, kept, "id", "part").count() == 0
    change = lambda f: spark.createDataFrame(f(list(rows)), d.schema)
    found = lambda f: {(r["part"], r["change"], r["now"] - r["was"]) for r in manifest.verified(change(f), kept, "id", "part").collect()}
    assert found(lambda x: [(1, "p1", "other"), *x[:1], *x[2:]]) == {("p1", "changed", 0)}
    assert found(lambda x: x[:2] + x[3:]) == {("p2", "lost", -1)}
    assert found(lambda x: [*x, x[5]]) == {("", "added", 1)}
    assert found(lambda x: [*x[:7], (7, "p1", ""), *x[8:]]) == {("p1", "changed", 0)}  # null and empty differ
    assert found(lambda x: [*x[:3], (3, "p9", x[3][2]), *x[4:]]) == {("p0", "lost", -1), ("p9", "added", 1)}
    assert [r["level"] for r in manifest.manifest(d.where("false"), "id", "part").collect()] == ["root"]
    train = spark.createDataFrame([("TEXT   1",), (None,)], "text string")
    assert sorted(r["id"] for r in manifest.isolated(d, train).collect()) == [k for k, _, t in rows if t and k != 1]


def brute(ids, x, asked, k):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    least = {}
    for i, v in zip(ids, x, strict=True):
        least[v.tobytes()] = min(i, least.get(v.tobytes(), i))
    keys = list(least)
    m = np.stack([np.frombuffer(b, x.dtype) for b in keys])
    out = {}
    for i, v in zip(ids, x, strict=True):
        if i in asked:
            s = [(-round(float(c), 4), least[b]) for b, c in zip(keys, m @ v, strict=True) if b != v.tobytes()]
            out[i] = sorted(s)[:k]
    return out


def test_neighbours_against_all_pairs(spark, monkeypatch):
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    for name, value in (("CELL_CLASSES", 60), ("BLOCK", 50), ("ASKED", 3)):  # 33 cells of many blocks
        monkeypatch.setattr(vectors, name, value)
    hot = e.where("vec_id = 7").withColumn("vec_id", F.explode(F.sequence(F.lit(10_000), F.lit(10_700))))
    odd = spark.createDataFrame([(20_000, None, 1), (20_050, [], 1), (20_100, [0.0] * 64, 1), (None, [1.0] * 64, 1), (20_150, [1.0, 2.0], 1)], e.schema)
    d = e.unionByName(hot).unionByName(odd)
    got = {}
    for r in vectors.neighbours(d, "vec_id", "embedding", F.col("vec_id") % 50 == 0).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append((r["neighbour"], r["copies"]))
    rows = [(r["vec_id"], r["embedding"]) for r in e.unionByName(hot).collect()] + [((1 << 63) - 1, [1.0] * 64)]
    ids, x = [i for i, _ in rows], np.array([v for _, v in rows], np.float32)
    want = brute(ids, x, {i for i in ids if i % 50 == 0}, 10)
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    right = sum(len({i for i, _ in got[q]} & {i for _, i in want[q]}) for q in want)
    assert right >= 0.9 * 10 * len(want)
    assert {n for v in got.values() for i, n in v if i == 7} <= {702} and not any(i == 7 for i, _ in got[10_000])
    assert vectors.neighbours(e.where("false"), "vec_id", "embedding", F.lit(True)).count() == 0
    assert vectors.neighbours(odd.where("size(embedding) = 0"), "vec_id", "embedding", F.lit(True)).count() == 0


def test_one_bad_row_fails_alone(spark):
    d = spark.createDataFrame([(k, None if k == 3 else f"t{k}") for k in range(6)], "k int, t string")

    def cut(row):
        if row["k"] == 1:
            return None
        if row["k"] == 2:
            return [{"a": 1}, {"a": 2, "b": "x"}]
        if row["k"] == 4:
            return {"c": 1}
        return {"a": len(row["t"]), "b": row["t"]} if row["k"] != 5 else {"a": "no number"}

    got = sorted(tuple(r) for r in plugins.processed(d, cut, "a long, b string").select("k", F.coalesce("a", F.lit(-1)), F.coalesce("b", F.lit("")), F.coalesce(F.substring_index("error", ":", 1), F.lit(""))).collect())
    assert got == [(0, 2, "t0", ""), (2, 1, "", ""), (2, 2, "x", ""), (3, -1, "", "TypeError"), (4, -1, "", "ValueError"), (5, -1, "", got[-1][3])] and got[-1][3].startswith("Arrow")
    assert plugins.processed(d.where("false"), cut, "a long").count() == 0


def test_judges(spark):
    d = spark.createDataFrame([(1, 0.2), (2, 0.7), (3, 3.0)], "k int, x double")
    got = {r["k"]: (r["score"], r["passed"], r["error"] is None) for r in plugins.judged(d, plugins.Judge(lambda r: r["x"])).collect()}
    assert got == {1: (0.2, False, True), 2: (0.7, True, True), 3: (None, None, False)}
    weighted = plugins.Judge(lambda r: {"dimensions": {"a": r["x"], "b": 1}, "comment": "c"}, most=10, threshold=1, weights=(("a", 0.5), ("b", 0.5)))
    assert [(r["score"], r["passed"], r["dimensions"]) for r in plugins.judged(d.where("k = 3"), weighted).collect()] == [(2.0, True, {"a": 3.0, "b": 1.0})]
    for bad in ({"least": 1, "most": 0}, {"threshold": 2}, {"weights": (("a", -1),)}):
        with pytest.raises(ValueError, match="a judge needs"):
            plugins.Judge(lambda r: 0, **bad)


def test_rows_without_elements_keep_a_reason(spark):
    row = lambda name, rows: [(r["reject_reason"]) for r in normalizers.normalize(spark.createDataFrame([(f"{name}/x/f.json", t) for t in rows], "file string, t string").select("file", F.try_parse_json("t").alias("row")), name).collect()]
    assert sorted(map(str, row("chembench", ["no json", '{"examples": []}', '{"uuid": "1"}', '{"examples": [{"input": "q", "target": "a"}]}']))) == ["None", "json_parse_error", "no_examples", "no_examples"]
    assert sorted(map(str, row("CUAD", ["no json", '{"paragraphs": []}', '{"paragraphs": [{"context": "c", "qas": []}, {"qas": [{"question": "q", "answers": [{"text": "t"}]}]}]}']))) == ["None", "json_parse_error", "no_questions", "no_questions"]


def test_a_mapped_letter_stays_in_the_metadata(spark):
    rows = [("q one", " B ", ["alpha text", "beta text"], "", "test", '{"subject": "s", "answer_letter": "old"}'), ("q two", "beta text", ["alpha text", "beta text"], "", "test", '{"subject": "s"}'), ("q three", "A", ["alpha text", "beta text"], "", "test", None)]
    d = spark.createDataFrame(rows, "question string, answer string, options array<string>, solution string, split string, metadata string")
    got = [(r["answer"], r["extra"]) for r in evalset.cleaned(d).withColumn("extra", evalbuild.extra(F.col("metadata"))).collect()]
    assert got == [("beta text", '{"answer_letter":"B","subject":"s"}'), ("beta text", '{"subject":"s"}'), ("alpha text", '{"answer_letter":"A"}')]

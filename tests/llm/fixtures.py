"""Small tables with the awkward cases: nulls in every column, empty and very long texts, ties, repeated rows, clashing names."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = ["key", "part", "row", "score", "size", "a", "b", "cid", "h", "target", "count", "value", "__key", "__copies", "__one", "__row_id", "__row_hash", "id", "stays", "copies", "col"]


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward_rows(seed=3):
    rng = random.Random(seed)
    rows = [(k, words(rng, rng.randrange(1, 120)), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", None]), k) for k in range(40)]
    rows += [(50, None, None, None, None), (51, "", "en", "s1", 0), (52, " \t\n", "en", "s1", 3), (None, words(rng, 30), "en", "s1", 1), (None, None, None, None, None)]
    rows += [(53, words(rng, 30_000, 5_000), "en", "s2", 9)]
    rows += [(54, rows[3][1], "en", "s1", 1), (55, rows[3][1].upper(), "en", "s1", 1), rows[4], rows[4]]
    return rows


def frame(spark, rows=None, extra=False):
    df = spark.createDataFrame(awkward_rows() if rows is None else rows, DOCS)
    if extra:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("clash") for c in EXTRA})
    return df

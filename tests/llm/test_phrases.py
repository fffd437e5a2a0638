"""Collocations against brute force."""

import re
from collections import Counter

import pytest
from fixtures import DOCS, awkward_rows, frame

from tamis.llm import phrases


def naive(rows, least, longest, top, share):
    """rows: (text, lang)."""
    n, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    good = {key: c for key, c in f.items() if len(key[1]) > 1 and c >= least}
    holds = lambda long, short: any(long[i : i + len(short)] == short for i in range(len(long) - len(short) + 1))
    out = {}
    for (lang, w), a in good.items():
        if any(x == lang and len(v) > len(w) and 100 * c >= share * a and holds(v, w) for (x, v), c in good.items()):
            continue
        score, _, l, r = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    return {(lang, rank, p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items() for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)}


def got(df):
    return {(r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect()}


def texts():
    out = [(t, lang) for _, t, lang, _, _ in awkward_rows()]
    out += [("new  york\tcity hall, New York CITY HALL! new york. york a a a a a", "en"), ("É b é B; é b\x0bb\x85c d e é b", None), ("x " * 60, "de"), (".,;:!? \t\r", "de"), ("one two three four five six seven. " * 5, "und")] * 3
    return out


@pytest.mark.parametrize(("least", "longest", "top", "share"), [(3, 5, 2_000, 100), (2, 4, 7, 80), (4, 2, 2_000, 100), (3, 7, 50, 100)])
def test_equals_brute_force(spark, least, longest, top, share):
    df = frame(spark, [(k, *x, "s", 1) for k, x in enumerate(texts())], extra=True).repartition(5)
    found = got(phrases.phrases(df, least, longest, top, share))
    assert found and found == naive(texts(), least, longest, top, share)


def test_small_buffers_and_a_full_bit_table_change_nothing(spark, monkeypatch):
    want = naive(texts(), 3, 5, 2_000, 100)
    for name, value in (("BUFFER", 40), ("ROWS", 7), ("LEAST_BITS", 6), ("MOST_BITS", 6)):
        monkeypatch.setattr(phrases, name, value)
    rows = texts()
    out = Counter()
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([x or "und" for _, x in rows], pa.string()), pa.array([t for t, _ in rows], pa.string())], names=["lang", "text"])
    for b in phrases.buffers([batch]):
        for found in b.counted(2, None):
            for lang, phrase, n in zip(*(c.to_pylist() for c in found.columns), strict=True):
                out[lang, phrase] += n
    assert all(out[lang, phrase] == a for lang, _, phrase, a, *_ in want if phrase.count(" ") == 1)
    df = frame(spark, [(k, *x, "s", 1) for k, x in enumerate(rows)])
    assert got(phrases.phrases(df, 3)) == want  # 64 bits let nearly every phrase through


def test_products_beyond_64_bits(spark):
    n = 4_000_000_000_000_000
    all_levels = spark.createDataFrame([("en", "a", 1, n // 2), ("en", "b", 1, 100), ("en", "a b", 2, 100)], "lang string, phrase string, k int, f long")
    row, = phrases.cuts(all_levels, spark.createDataFrame([("en", n)], "lang string, n long")).collect()
    assert row["score"] == 1000 * 100 * n // (n // 2 * 100)


def test_tables_without_phrases(spark):
    assert phrases.phrases(spark.createDataFrame([], DOCS)).count() == 0
    assert phrases.phrases(frame(spark, [(1, None, None, None, None), (2, "", "en", "s", 1)])).count() == 0

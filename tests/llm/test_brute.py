"""Whole results of operators without SQL against plain versions that share no code with them."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from fixtures import awkward_rows, frame

from tamis.llm import decontaminate, toxicity

# --- toxicity: features, voters, label model, classifier and scores, row by row --------------------

EDGE = ".,;:!?\"'`()[]{}<>%&$#*|_~^+=/\\-"
YOU = "you your yours u ur du dich dir dein deine euch ihr tu te toi ton ta vous votre usted ustedes ti tus tuyo".split()


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def plain_features(word):
    w = word.strip(EDGE).lower()
    return [("w", w)] + [(k, w[:k]) for k in (4, 5, 6, 7, 8) if len(w) >= k] if w else []


def plain_model(rows):
    """rows: (text, toxic). Weights by feature and the bias."""
    n1, n0 = sum(t for _, t in rows), sum(1 - t for _, t in rows)
    in_docs = collections.defaultdict(lambda: [0, 0])
    for text, toxic in rows:
        for f in {f for w in split(text) for f in plain_features(w)}:
            in_docs[f][toxic] += 1
    strong = []
    for f, (c, t) in in_docs.items():
        p1, p0, p = t / n1, c / n0, (t + c) / len(rows)
        z = (p1 - p0) / math.sqrt(p * (1 - p) * (1 / n1 + 1 / n0) + 1e-12)
        if t >= 2 and z >= 3 and p1 >= 3 * p0:
            strong.append((-z, f"{f[0]}:{f[1]}".encode(), f))
    order = [f for _, _, f in sorted(strong)]
    assert 10 < len(order) <= toxicity.FEATURES
    voter = {}
    for kind in ("w", 4, 5, 6, 7, 8):
        mine = [f for f in order if f[0] == kind]
        for rank, f in enumerate(mine):
            voter[f] = (kind, min(2, rank * 3 // len(mine)))
    names = [(kind, tier) for kind in ("w", 4, 5, 6, 7, 8) for tier in range(3)]
    votes, rates = [], []
    for text, _ in rows:
        words = split(text)
        hits = collections.Counter(f for w in words for f in plain_features(w) if f in voter)
        by = collections.Counter()
        for f, c in hits.items():
            by[voter[f]] += c
        row = []
        for v in names:
            rate = 100 * by[v] / (len(words) + 40)
            row.append(1.0 if rate >= 1.5 else -1.0 if rate < 0.5 else 0.0)
        folded = [w.strip(EDGE).lower() for w in words]
        n = len(words) + 1
        shares = (
            (sum(c.isupper() for c in text) / (sum(c.isalpha() for c in text) or 1), 0.5), (text.count("!") / n, 0.3), (len(re.findall(r"([^\W\d_])\1\1", text)) / n, 0.05),
            (max(collections.Counter(folded).values(), default=0) / n, 0.4), (sum(w in YOU for w in folded) / n, 0.08),
        )
        votes.append(row + [1.0 if s > least else 0.0 for s, least in shares])
        rates.append([hits[f] * 100 / (len(words) + 40) for f in order])
    v, x, y = np.array(votes), np.array(rates), np.array([t for _, t in rows], float)
    q = ((v > 0).sum(1) + 0.5) / ((v != 0).sum(1) + 1.0)
    for _ in range(20):
        w1, w0 = q.sum(), (1 - q).sum()
        if min(w1, w0) < 1:
            break
        m1, m0 = sum(a * b for a, b in zip(q, v, strict=True)) / w1, sum((1 - a) * b for a, b in zip(q, v, strict=True)) / w0
        cov = sum(a * np.outer(b - m1, b - m1) + (1 - a) * np.outer(b - m0, b - m0) for a, b in zip(q, v, strict=True)) / len(v)
        cov = 0.7 * cov + np.eye(len(cov)) * (0.3 * np.trace(cov) / len(cov) + 0.05)
        logit = (v - (m1 + m0) / 2) @ np.linalg.solve(cov, m1 - m0) + math.log(w1 / w0)
        q = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    if np.cov(q, y)[0, 1] < 0:
        q = 1 - q
    w, b = np.zeros(len(order)), math.log(max(q.mean(), 1e-3) / max(1 - q.mean(), 1e-3))
    sw, sb = np.full(len(order), 1e-6), 1e-6
    for _ in range(300):
        g = (1 / (1 + np.exp(-np.clip(b + x @ w, -30, 30))) - q) / len(rows)
        gw, gb = x.T @ g + 1e-4 * w, g.sum()
        sw, sb = sw + gw**2, sb + gb**2
        w, b = w - 0.5 * gw / np.sqrt(sw), b - 0.5 * gb / np.sqrt(sb)
    return dict(zip(order, w, strict=True)), b


def test_toxicity_from_texts_to_scores(spark):
    rng = random.Random(9)
    bad = [f"vile{k}ness" for k in range(12)] + ["STUPID!", "you"]
    rows, labels = [], []
    for k in range(160):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 60))]
        toxic = int(k % 4 == 0)
        if toxic:
            for _ in range(rng.randrange(3, 9)):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((k, " ".join(words), "en", "s", 1))
        labels.append((k, toxic))
    rows += [(500, None, None, None, None), (501, "", "en", "s", 1), (502, "é !!! (vile3ness)", "en", "s", 1)]
    learned = [(text, t) for (k, text, *_), (_, t) in zip(rows, labels, strict=False) if zlib.crc32(str(k).encode()) % 5]
    weight, bias = plain_model(learned)
    docs = frame(spark, rows, extra=True)
    model = toxicity.fitted(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r["doc_id"]: (r["score"], r["predicted"]) for r in toxicity.scored(docs.selectExpr("*", "false as held_out"), model).collect()}
    for k, text, *_ in rows:
        words = split(text or "")
        z = bias + 100 * sum(weight.get(f, 0.0) for w in words for f in plain_features(w)) / (len(words) + 40)
        score = 1 / (1 + math.exp(-max(-40, min(40, z))))
        assert got[k] == (pytest.approx(score, abs=1e-6), int(score >= 0.5)), k
    assert sum(got[k][1] == t for k, t in labels) > 0.95 * len(labels)


# --- decontamination: plain Smith-Waterman over every document and item ----------------------------


def smith_waterman(item, words):
    """(least, most) words matched on the best local alignments: equal 2, exchanged -1, put in or left out -1."""
    best, low, high = 0, 0, 0
    above = [(0, 0, 0)] * (len(words) + 1)
    for a in item:
        row = [(0, 0, 0)]
        for j, b in enumerate(words, 1):
            s, lo, hi = above[j - 1]
            ways = [(0, 0, 0), (s + 2, lo + 1, hi + 1) if a == b else (s - 1, lo, hi), (above[j][0] - 1, *above[j][1:]), (row[j - 1][0] - 1, *row[j - 1][1:])]
            top = max(w[0] for w in ways)
            ties = [w for w in ways if w[0] == top]
            cell = (0, 0, 0) if top <= 0 else (top, min(w[1] for w in ties), max(w[2] for w in ties))
            row.append(cell)
            if cell[0] > best:
                best, low, high = cell
            elif cell[0] == best and best:
                low, high = min(low, cell[1]), max(high, cell[2])
        above = row
    return low, high


def test_alignment_is_smith_waterman():
    rng = random.Random(2)
    for _ in range(400):
        item = [rng.randrange(6) for _ in range(rng.randrange(1, 14))]
        words = [rng.randrange(6) for _ in range(rng.randrange(0, 30))]
        low, high = smith_waterman(item, words)
        got = decontaminate.align(np.array(item, np.uint64), np.array(words, np.uint64)) * len(item)
        assert low - 1e-6 <= got <= high + 1e-6


def test_contaminated_documents_by_plain_alignment(spark):
    rng = random.Random(6)
    items = [(k, " ".join(f"I{rng.randrange(300)}," for _ in range(12 + 5 * k))) for k in range(5)]
    rows = [r for r in awkward_rows() if not r[1] or len(r[1]) < 5_000]
    for k in range(40):
        words = items[k % 5][1].lower().split()
        for _ in range(len(words) * (k // 10) // 10):
            at = rng.randrange(len(words))
            words[at : at + rng.randrange(2)] = [f"x{rng.randrange(99)}"]
        rows.append((3_000 + k, " ".join([f"n{rng.randrange(300)}" for _ in range(50)] + words + [f"n{rng.randrange(300)}" for _ in range(50)]), "en", "s", 1))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    fold = lambda t: [w for w in (x.strip(EDGE).lower() for x in split(t or "")) if w]
    sure = 0
    for doc, text, *_ in rows:
        for item, t in items:
            low, high = (x / len(fold(t)) for x in smith_waterman(fold(t), fold(text)))
            if low >= decontaminate.LEAST:
                sure += 1
                assert (doc, item) in got
            elif high < decontaminate.LEAST:
                assert (doc, item) not in got
    assert sure >= 30


# --- the pipeline, stage after stage ----------------------------------------------------------------


def plain_groups(docs):
    """Smallest id of each document's group of near copies, by all pairs of shingle sets."""
    sets = {}
    for k, text in docs.items():
        w = split(text.lower())
        sets[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    group = {k: {k} for k in docs}
    for a in docs:
        for b in docs:
            shared = len(sets[a] & sets[b])
            if a < b and shared and 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared) and group[a] is not group[b]:
                group[a] |= group[b]
                for k in group[b]:
                    group[k] = group[a]
    return {k: min(g) for k, g in group.items()}


def test_pipeline_against_plain_stages(spark, tmp_path):
    import duckdb
    import pandas as pd
    from tokenizers import Tokenizer

    import corpus_pipeline
    from tamis.llm import oracles, token_ids

    rng = random.Random(31)
    items = [(k, " ".join(f"item{rng.randrange(500)}" for _ in range(20 + 4 * k))) for k in range(4)]
    bad, docs, labels = [f"vile{k}ness" for k in range(8)], {}, []
    for k in range(170):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(20, 90))]
        toxic = int(k % 5 == 1)
        if toxic:
            for _ in range(rng.randrange(5, 10)):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        if k % 17 == 2:
            words[5:5] = items[k % 4][1].split()
        if k % 11 == 3 and k > 11:
            words = split(docs[k - 11]) + ["more"]
        docs[k] = " ".join(words)
        labels.append((k, toxic))
    source = {k: ["a", "b", "c", None][k % 4] for k in docs}
    frame(spark, [(k, t, "en", source[k], len(t)) for k, t in docs.items()]).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, toxic int").coalesce(1).write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))

    weight, bias = plain_model([(docs[k], t) for k, t in labels if zlib.crc32(str(k).encode()) % 5])
    rate = lambda text: bias + 100 * sum(weight.get(f, 0.0) for w in split(text) for f in plain_features(w)) / (len(split(text)) + 40)
    kept = {k: t for k, t in docs.items() if rate(t) < 0}
    assert 100 < len(kept) < len(docs)
    groups = plain_groups(kept)
    once = {k: t for k, t in kept.items() if groups[k] == k}
    assert len(once) < len(kept)
    clean = {}
    for k, t in once.items():
        shares = [[x / len(split(i)) for x in smith_waterman(split(i), split(t))] for _, i in items]
        assert all(low >= decontaminate.LEAST or high < decontaminate.LEAST for low, high in shares)
        if all(high < decontaminate.LEAST for _, high in shares):
            clean[k] = t
    assert len(clean) < len(once)
    con = duckdb.connect()
    con.register("documents", pd.DataFrame([(k, t, source[k]) for k, t in clean.items()], columns=["doc_id", "text", "source"]))
    cursor = con.execute(oracles.mixing_sql())
    names = [c[0] for c in cursor.description]
    copies = {r[names.index("doc_id")]: r[names.index("copies")] for r in cursor.fetchall()}
    assert {0, 1, 2} <= set(copies.values())
    encode, start, want = Tokenizer.from_file(token_ids.default_tokenizer()), 0, []
    for k in sorted(clean):
        for _ in range(copies[k]):
            ids = [*encode.encode(clean[k], add_special_tokens=False).ids, 1]
            want.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
    got = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == want

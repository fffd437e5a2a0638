"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

1. From a bounded sample of labelled training rows, words and word beginnings that stand far more often in
   toxic than in clean documents are mined; they make up the voters' lexicons.
2. Voters: a lexicon for each kind of pattern (word, beginnings of 4 to 8 letters) and tier of
   strength, and text patterns that no label has taught (shouting, exclamation marks, drawn-out letters, one word
   over and over, address to a reader). A voter says toxic, clean, or abstains.
3. The label model is a two-class mixture over the votes: EM estimates the classes' mean votes
   (the voters' accuracies, see ``accuracies``), and the pooled within-class covariance (their correlations), so
   that voters which echo each other don't count twice. It starts from the share of the voters that say toxic and gives
   posterior labels; the training labels only tell which of the two classes is the toxic one.
4. A logistic regression on lexicon rates learns these posterior labels alone, and scores every document.

Inputs of a score are the text alone. Rows in the held-out fold teach nothing. Null or empty text
is scored like any (its rates are 0). Without training rows of both classes every score
is 1 / (1 + e^40), next to 0. Texts of any length are scored whole, an empty table gives no rows, equal scores need nothing special. Repeated ids in the labels: toxic if any row says so; null labels are left out; null ids have no label and
count as the empty string in the split. Columns beyond those named are ignored.
"""

from __future__ import annotations

import collections
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.llm.common import CACHE_ENTRIES, fold, released, small_batches, table, written

# Labelled rows that lexicons, label model and classifier are fitted on, at most; chosen by hash of the id.
TRAINING_DOCS = 12_000
# Features of the lexicons, at most: the strongest by their z value.
FEATURES = 2_000
# Of a task that mines: features counted before their counts go out in part, and words whose features it remembers.
COUNTED, CUT_WORDS = 200_000, 50_000
LENGTHS = (4, 5, 6, 7, 8)
LEAST_Z, LEAST_RATIO = 3.0, 3.0
SMOOTH = 40  # words added to a text's length in rates
SAYS_TOXIC, SAYS_CLEAN = 1.5, 0.5  # hits in 100 words
# Text patterns: the least share at which each says toxic; below it, it abstains.
PATTERNS = {"shout": 0.5, "marks": 0.3, "drawn": 0.05, "again": 0.4, "address": 0.08}
ADDRESS = frozenset(b"you your yours u ur du dich dir dein deine euch ihr tu te toi ton ta vous votre usted ustedes ti tus tuyo".split())
DRAWN = re.compile(r"([^\W\d_])\1\1")
TIERS = 3
EDGES = b".,;:!?\"'`()[]{}<>%&$#*|_~^+=/\\-"


def features_of(word: bytes) -> list[str]:
    """The folded word and its beginnings."""
    core = word.strip(EDGES)
    w = core.decode().lower()
    return [f"w:{w}", *(f"{k}:{w[:k]}" for k in LENGTHS if len(w) >= k)] if w else []


class Known(dict):
    """word -> numbers of its known features."""

    def __init__(self, number: dict[str, int]):
        self.number = number

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        value = self[word] = tuple(self.number[f] for f in features_of(word) if f in self.number)
        return value


class Weights(dict):
    """word -> sum of its features' weights."""

    def __init__(self, weight: dict[str, float]):
        self.weight = weight

    def __missing__(self, word: bytes) -> float:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        value = self[word] = sum(self.weight.get(f, 0.0) for f in features_of(word))
        return value


def training_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """doc_id, text, toxic of at most ``most`` labelled rows (more only if ids repeat in docs)."""
    named = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = named.where(fold("doc_id", 5) != 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``most`` narrow rows


def feature_counts(batches: Iterable[pa.RecordBatch], most: int = COUNTED) -> Iterator[pa.RecordBatch]:
    """Batches of text and toxic: in how many clean and toxic ones each feature stands. Counts go out in parts when more than ``most`` are held."""
    clean, toxic = collections.Counter(), collections.Counter()
    words: dict[bytes, list[str]] = {}

    def part():
        names = [*clean, *(f for f in toxic if f not in clean)]
        return pa.RecordBatch.from_arrays([pa.array(names, type=pa.string()), *(pa.array([c[f] for f in names], type=pa.int64()) for c in (clean, toxic))], names=["feature", "clean", "toxic"])

    for b in batches:
        for text, mark in zip(b.column(0).cast(pa.large_binary()).to_pylist(), b.column(1).to_pylist(), strict=True):
            seen = set()
            for w in set((text or b"").split()):
                if w not in words:
                    if len(words) >= CUT_WORDS:
                        words.clear()
                    words[w] = features_of(w)
                seen.update(words[w])
            (toxic if mark > 0 else clean).update(seen)
            if len(clean) + len(toxic) > most:
                yield part()
                clean.clear()
                toxic.clear()
    yield part()


def mined(rows: DataFrame, most: int = FEATURES) -> list[str]:
    """Features of toxic documents, the strongest first."""

    n = rows.agg(F.count(F.when(F.col("toxic") > 0, 1)), F.count(F.when(F.col("toxic") <= 0, 1))).first()
    if not n or not n[0] or not n[1]:
        return []
    both = rows.select("text", "toxic").mapInArrow(lambda batches: feature_counts(released(batches)), "feature string, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    p1, p0 = F.col("toxic") / n[0], F.col("clean") / n[1]
    p = (F.col("toxic") + F.col("clean")) / (n[0] + n[1])
    z = (p1 - p0) / F.sqrt(p * (1 - p) * (1 / n[0] + 1 / n[1]) + 1e-12)
    strong = both.where("toxic >= 2").select("feature", z.alias("z")).where((F.col("z") >= LEAST_Z) & (p1 >= LEAST_RATIO * p0))
    return [r["feature"] for r in strong.orderBy(F.desc("z"), "feature").limit(most).collect()]


def patterns_of(text: bytes, words: list[bytes]) -> tuple[float, ...]:
    """The shares that the text patterns look at, in the order of PATTERNS."""
    s, n = text.decode(), len(words) + 1
    letters = sum(map(str.isalpha, s)) or 1
    folded = [w.strip(EDGES).lower() for w in words]
    again = max(collections.Counter(folded).values(), default=0) / n
    return sum(map(str.isupper, s)) / letters, s.count("!") / n, sum(1 for _ in DRAWN.finditer(s)) / n, again, sum(w in ADDRESS for w in folded) / n


def observed(rows: DataFrame, features: list[str]) -> pd.DataFrame:
    """Of each training row: toxic, n (words), the shares of PATTERNS, ids and counts of its features."""
    number = {f: k for k, f in enumerate(features)}

    def run(batches):
        known = Known(number)
        for b in released(batches):
            out = []
            for text, toxic in zip(b.column(0).cast(pa.large_binary()).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = (text or b"").split()
                hits: dict[int, int] = {}
                for ids in filter(None, map(known.__getitem__, words)):
                    for k in ids:
                        hits[k] = hits.get(k, 0) + 1
                out.append((int(toxic > 0), len(words), *patterns_of(text or b"", words), list(hits), list(hits.values())))
            cols = list(zip(*out, strict=True)) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, kinds.values(), strict=True)], names=list(kinds))

    kinds = {"toxic": pa.int64(), "n": pa.int64(), **dict.fromkeys(PATTERNS, pa.float64()), "ids": pa.list_(pa.int32()), "counts": pa.list_(pa.int32())}
    shares = ", ".join(f"{name} double" for name in PATTERNS)
    return rows.select("text", "toxic").mapInArrow(run, f"toxic long, n long, {shares}, ids array<int>, counts array<int>").toPandas()


def voters_of(features: list[str]) -> np.ndarray:
    """The voter of each feature: its kind, and its tier of strength among that kind."""
    kinds = [f.split(":", 1)[0] for f in features]
    names = ["w", *map(str, LENGTHS)]
    out = np.zeros(len(features), dtype=np.int64)
    for k, name in enumerate(names):
        mine = [i for i, x in enumerate(kinds) if x == name]
        for rank, i in enumerate(mine):
            out[i] = k * TIERS + min(TIERS - 1, rank * TIERS // max(1, len(mine)))
    return out


def votes(seen: pd.DataFrame, features: list[str]) -> np.ndarray:
    voter = voters_of(features)
    m = (len(LENGTHS) + 1) * TIERS
    hits = np.zeros((len(seen), m))
    for r, (ids, counts) in enumerate(zip(seen["ids"], seen["counts"], strict=True)):
        np.add.at(hits[r], voter[np.asarray(ids, dtype=int)], np.asarray(counts, dtype=float))
    rate = 100 * hits / (seen["n"].to_numpy()[:, None] + SMOOTH)
    lexical = np.where(rate >= SAYS_TOXIC, 1.0, np.where(rate < SAYS_CLEAN, -1.0, 0.0))
    patterns = np.stack([np.where(seen[name] > least, 1.0, 0.0) for name, least in PATTERNS.items()], axis=1)
    return np.concatenate([lexical, patterns], axis=1)


def vote_prior(v: np.ndarray) -> np.ndarray:
    """Share of the voters that say toxic among those that vote, drawn a little to the middle."""
    toxic, cast = (v > 0).sum(axis=1), (v != 0).sum(axis=1)
    return (toxic + 0.5) / (cast + 1.0)


def named(q: np.ndarray, y: np.ndarray) -> np.ndarray:
    """q, or 1 - q where the mixture's second class goes with the training labels."""
    return 1 - q if np.cov(q, y)[0, 1] < 0 else q


def accuracies(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Of each voter the share of its votes that the posterior q bears out; 0.5 where it never votes."""
    cast = np.abs(v).sum(axis=0)
    right = (np.where(v > 0, q[:, None], 0) + np.where(v < 0, 1 - q[:, None], 0)).sum(axis=0)
    return np.where(cast > 0, right / np.maximum(cast, 1), 0.5)


def posterior(v: np.ndarray, start: np.ndarray, rounds: int = 20) -> np.ndarray:
    """Posterior of class toxic from votes v, by EM from starting beliefs: class means and a pooled covariance."""
    q = start.astype(float)
    for _ in range(rounds):
        w1, w0 = q.sum(), (1 - q).sum()
        if min(w1, w0) < 1:
            break
        m1, m0 = (q[:, None] * v).sum(0) / w1, ((1 - q)[:, None] * v).sum(0) / w0
        d1, d0 = v - m1, v - m0
        cov = ((q[:, None] * d1).T @ d1 + ((1 - q)[:, None] * d0).T @ d0) / len(v)
        cov = 0.7 * cov + np.eye(len(cov)) * (0.3 * np.trace(cov) / len(cov) + 0.05)
        direction = np.linalg.solve(cov, m1 - m0)
        logit = (v - (m1 + m0) / 2) @ direction + np.log(w1 / w0)
        q = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return q


def logistic(seen: pd.DataFrame, n_features: int, target: np.ndarray, steps: int = 300, l2: float = 1e-4, rate: float = 0.5) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression of the target on rates of features in 100 words."""
    rows = np.repeat(np.arange(len(seen)), [len(x) for x in seen["ids"]])
    ids = np.concatenate([np.asarray(x, dtype=np.int64) for x in seen["ids"]]) if len(rows) else np.empty(0, np.int64)
    x = (np.concatenate([np.asarray(c, dtype=float) for c in seen["counts"]]) if len(rows) else np.empty(0)) * (100 / (seen["n"].to_numpy()[rows] + SMOOTH))
    w, b = np.zeros(n_features), float(np.log(max(target.mean(), 1e-3) / max(1 - target.mean(), 1e-3)))
    sw, sb = np.full(n_features, 1e-6), 1e-6
    for _ in range(steps):
        z = b + np.bincount(rows, weights=x * w[ids], minlength=len(seen))
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / len(seen)
        gw, gb = np.bincount(ids, weights=x * g[rows], minlength=n_features) + l2 * w, g.sum()
        sw, sb = sw + gw * gw, sb + gb * gb
        w, b = w - rate * gw / np.sqrt(sw), b - rate * gb / np.sqrt(sb)
    return w, float(b)


def fitted(docs: DataFrame, labels: DataFrame, most: int = TRAINING_DOCS) -> tuple[dict[str, float], float] | None:
    """docs: doc_id, text; labels: doc_id, toxic. Weight of each feature, and the bias; None without rows of both classes."""
    small_batches(docs.sparkSession)
    rows = written(training_rows(docs, labels, most), "toxicity-sample")  # read more than once below
    features = mined(rows)
    if not features:
        return None
    seen = observed(rows, features)
    v = votes(seen, features)
    q = named(posterior(v, vote_prior(v)), seen["toxic"].to_numpy(dtype=float))
    w, b = logistic(seen, len(features), q)
    return {f: float(x) for f, x in zip(features, w, strict=True) if x}, b


def scored(docs: DataFrame, model: tuple[dict[str, float], float] | None) -> DataFrame:
    """docs: doc_id, text, held_out. doc_id, held_out, score and predicted."""
    small_batches(docs.sparkSession)
    weight, bias = model or ({}, -100.0)

    def run(batches):
        weights = Weights(weight)
        for b in released(batches):
            z = []
            for text in b.column(1).cast(pa.large_binary()).to_pylist():
                words = (text or b"").split()
                z.append(bias + 100 * sum(map(weights.__getitem__, words)) / (len(words) + SMOOTH))
            score = 1 / (1 + np.exp(-np.clip(np.array(z, dtype=float), -40, 40)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", "text", "held_out").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, held_out, score, predicted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fitted(docs, table(spark, sf_dir, "labels"))
    return scored(docs.withColumn("held_out", fold("doc_id", 5) == 0), model)


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows whose text is predicted toxic; same columns, in one pass over the rows."""
    weight, bias = fitted(docs, labels) or ({}, -100.0)
    small_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches):
        weights = Weights(weight)
        for b in released(batches):
            keep = []
            for text in b.column(at).cast(pa.large_binary()).to_pylist():
                words = (text or b"").split()
                keep.append(bias + 100 * sum(map(weights.__getitem__, words)) / (len(words) + SMOOTH) < 0)
            yield b.filter(pa.array(keep, type=pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
